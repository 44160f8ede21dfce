"""Golden values (LAMBDA=20) for the sample review files, see FIXTURES.md."""

# demo_reviews.csv, 10 iterations: user -> (initial mean, General, Product)
DEMO = {
    "Antonio": (0.479365, 0.52936506, 0.56666666),
    "Barbara": (0.247222, 0.29277968, 0.39184678),
    "Carlo": (-0.086310, 0.16072817, 0.08054753),
    "Davide": (-0.142857, -0.0061873365, -0.013769115),
    "Erica": (-0.702778, -0.381992, -0.6944444),
    "Fabrizio": (0.000000, 0.2194075, 0.12268636),
    "Gianluigi": (0.369048, 0.6363706, 0.52590305),
    "Haley": (1.000000, 1.0, 1.0),
    "Iginio": (0.208333, 0.36527815, 0.36423376),
    "Luca": (0.254329, 0.46874952, 0.40673307),
    "Matteo": (0.750000, 0.8833332, 0.8749999),
    "Nunzia": (0.500000, 0.5, 0.5833333),
    "Orazio": (0.500000, 0.5, 0.5833333),
    "Pierluigi": (0.066667, 0.47694218, 0.33333334),
    "Quirico": (0.055556, 0.32395202, 0.23986113),
    "Renato": (-0.111111, 0.49982435, 0.6152778),
    "Sabrina": (0.111111, 0.3770244, 0.46759495),
    "Teresa": (0.333333, 0.6563237, 0.50000006),
    "Ugo": (0.333333, 0.49119046, 0.33333334),
    "Valentina": (1.000000, 1.0, 1.0),
    "Zeno": (0.523810, 0.7150001, 0.6666667),
}

# three_products.csv: user -> (initial, General it1, General it10, Product it1, Product it10)
THREE = {
    "A": (0.682540, 0.699206, 0.849206, 0.699206, 0.777778),
    "B": (0.333333, 0.367460, 0.712103, 0.350000, 0.500000),
    "C": (-0.222222, -0.180258, 0.266296, -0.200000, 0.037500),
    "D": (-1.000000, -0.977480, -0.716164, -0.966667, -0.737031),
    "E": (-1.000000, -0.988591, -0.932985, -0.995833, -0.995833),
    "F": (1.000000, 1.000000, 1.000000, 1.000000, 1.000000),
    "G": (0.166667, 0.183333, 0.333333, 0.179167, 0.291667),
    "H": (1.000000, 1.000000, 1.000000, 1.000000, 1.000000),
    "I": (0.000000, 0.022520, 0.256475, 0.020833, 0.208333),
    "L": (0.023810, 0.029365, 0.106627, 0.032143, 0.113393),
}

# quoted_ids.csv, 10 iterations: user -> (initial, General, Product)
QUOTED = {
    "1": (0.666667, 0.777778, 0.833333),
    "15": (-0.100000, 0.193988, 0.408631),
    "16": (0.250000, 0.250000, 0.250000),
    "17": (0.000000, 0.000000, 0.000000),
    "2": (0.555556, 1.000000, 0.611111),
    "21": (1.000000, 1.000000, 1.000000),
    "3": (0.603175, 0.893453, 0.742063),
    "4": (0.888889, 0.888889, 0.972222),
    "6": (0.428571, 1.000000, 1.000000),
    "8": (1.000000, 1.000000, 1.000000),
}

# file -> (reviews, users, products, zero-helpfulness reviews, General links, initial Product links)
COUNTS = {
    "quoted_ids.csv": (17, 10, 4, 3, 13, 9),
    "three_products.csv": (24, 10, 3, 6, 18, 18),
    "demo_reviews.csv": (90, 21, 10, 21, 92, 81),
    "cd_350.csv": (350, 340, 21, 73, 2364, 2342),
}
