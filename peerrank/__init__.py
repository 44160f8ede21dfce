"""peerrank: peer-endorsement ranking of reviewers on Spark DataFrames."""

from .operators.general import general_graph, general_rank
from .operators.links import general_links, product_link_pairs, product_links_after
from .operators.product import product_rank
from .operators.report import graph_links, graph_nodes, leaderboard, rank_bands, rank_trajectory, top_users, user_lookup
from .plans.job import rank_job, rank_reviews
from .sources.reviews import load_reviews, load_reviews_quarantine, reviews_from_tables
from .sources.runlog import parse_runlog, runlog_lines
from .sources.sinks import read_result, write_result

__all__ = [
    "general_graph", "general_links", "general_rank", "graph_links", "graph_nodes", "leaderboard",
    "load_reviews", "load_reviews_quarantine", "parse_runlog", "product_link_pairs", "product_links_after",
    "product_rank", "rank_bands", "rank_job", "rank_reviews", "rank_trajectory", "read_result",
    "reviews_from_tables", "runlog_lines", "top_users", "user_lookup", "write_result",
]
