"""Paths shared by the tests."""

import os

DATA = os.path.join(os.path.dirname(os.path.abspath(__file__)), "data")
SF_SMALL = "/root/testdata/sf0.001"
