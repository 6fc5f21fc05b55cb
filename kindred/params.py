"""Default parameters. Every one of them can be overridden by the caller."""

# The domain constants that results are defined against.
RATING_LO = 1.0
RATING_HI = 5.0
BASELINE_MAE = 0.7669
PERSONAL_USER_ID = 944
BYTES_PER_SIMILARITY = 8
RAM_BYTES = 4e9
VALUES_PER_NEIGHBOUR = 3
K_VALUES = (10, 30, 50, 100, 200, 300, 400, 800, 943)
RECOMMEND_K_VALUES = (30, 300)
TOP_N = 5
TIMING_RUNS = 5
EXPECTED_TRAIN_ROWS = 80000
EXPECTED_TEST_ROWS = 20000
EXPECTED_RATINGS_ROWS = 100000
EXPECTED_CATALOG_ROWS = 1682

# Similarities are rounded before they are compared with zero or ranked, so that the order in which
# partial sums arrive can neither create a non-zero similarity nor break a tie.
SIMILARITY_DECIMALS = 10

# Predictions are rounded before they are ranked or compared with the highest rating, for the same reason.
PREDICTION_DECIMALS = 6

# Largest number of ratings of one item that are joined with each other in one group. Items above it
# are spread over a grid of groups of this size, at any size of the input.
BLOCK_ROWS = 1024

# Number of matches within groups that one task of a join produces.
MATCHES_PER_TASK = 2_000_000

# Largest number of tasks that a join is dealt out to; beyond it, a task takes several groups or cells.
MOST_TASKS = 200_000

# Rows of two or three numbers that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 100_000

# Rows of pairs that one partition may hold after a shuffle.
PAIRS_PER_PARTITION = 2_000_000

# Entries of lists that are sent at once; the lists of more are sent and used in rounds, each for a part of the users.
ENTRIES_PER_ROUND = 300_000_000

# Largest k for which Spark limits a ranking before the shuffle, by its own default.
RANK_LIMIT = 1000
