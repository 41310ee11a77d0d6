"""Fixed values that must equal the reference's for the same results.

FIXED VALUES (domain constants, thresholds and labels, stated as they are used):

- valid order statuses: paid, shipped, completed
- all order statuses: pending, paid, shipped, completed, cancelled
- behaviour types: view, cart, fav, buy
- fixed RFM thresholds: recency <= 7 days -> 3, <= 30 days -> 2, else 1;
  order count >= 10 -> 3, >= 3 -> 2, else 1; spend >= 50000 -> 3, >= 10000 -> 2, else 1
- tier cut-offs on R+F+M: >= 7 high, >= 5 mid, else low
- RFM tercile probabilities: 0.33 and 0.66
- purchase-count buckets: 1, 2, 3-5, 6-10, >10
- RFM tercile labels: see RFM_LABEL_RULES, first match wins, otherwise new
- stream watermark delay 5 seconds, tumbling window 1 minute
- topics: user-behavior-log (behaviour events), order-stream (orders with items)
- lake datetime text: yyyy-MM-dd HH:mm:ss;
  stream JSON timestamps: yyyy-MM-dd HH:mm:ss
- ALS: rank 5, 5 iterations, regularisation 0.1, non-negative, seed 42, top 5;
  K-Means: k = 4, seed 42
"""

VALID_STATUSES = ("paid", "shipped", "completed")
ALL_STATUSES = ("pending", "paid", "shipped", "completed", "cancelled")
BEHAVIOR_TYPES = ("view", "cart", "fav", "buy")

RECENCY_DAYS = (7, 30)
ORDER_COUNT = (10, 3)
SPEND = (50000, 10000)
TIER_CUTOFFS = (7, 5)
TIER_LABELS = ("high", "mid", "low")

TERCILE_PROBS = (0.33, 0.66)

PURCHASE_BUCKETS = ("1", "2", "3-5", "6-10", ">10")

# conditions on r_score, f_score and m_score
RFM_LABEL_RULES = (
    ("r_score = 3 AND f_score >= 2 AND m_score >= 2", "key_value"),
    ("r_score = 3 AND f_score <= 1 AND m_score >= 2", "key_develop"),
    ("r_score <= 2 AND f_score >= 2 AND m_score >= 2", "key_retain"),
    ("r_score <= 2 AND f_score <= 1 AND m_score >= 2", "key_win_back"),
    ("r_score = 3 AND f_score >= 2 AND m_score <= 1", "general_value"),
    ("r_score <= 2 AND f_score >= 2 AND m_score <= 1", "general_retain"),
    ("r_score <= 2 AND f_score <= 1 AND m_score <= 1", "lost"),
)
RFM_DEFAULT_LABEL = "new"

WATERMARK_DELAY = "5 seconds"
WINDOW_DURATION = "1 minute"

BEHAVIOR_TOPIC = "user-behavior-log"
ORDER_TOPIC = "order-stream"
LAKE_DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
STREAM_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

ALS_PARAMS = dict(rank=5, maxIter=5, regParam=0.1, nonnegative=True, seed=42)
ALS_TOP_K = 5
KMEANS_K = 4
KMEANS_SEED = 42
