"""Default parameters. Every operator takes them as arguments."""

from datetime import datetime

# Results depend on them, so they equal the published defaults.
SNAPSHOT = datetime(2011, 12, 10)
CHURN_CUTOFF = datetime(2011, 9, 1)
CHURN_WINDOW_DAYS = 90
WINSOR = (0.01, 0.99)
SEED = 42

MIN_SUPPORT = 0.02
MIN_CONFIDENCE = 0.5
MIN_LIFT = 1.5
POPULAR_FRACTION = 0.005
POPULAR_FLOOR = 50
SEGMENT_MIN_SUPPORT = 0.02
SEGMENT_MIN_INVOICES = 50
SEGMENT_TOP_RULES = 10
TOP_RULES = 30
DESCRIPTION_WIDTH = 40

HIGH_RISK, MEDIUM_RISK = 0.70, 0.40
HIGH_SEGMENT_CHURN, MEDIUM_SEGMENT_CHURN = 0.70, 0.40
RARE_COUNTRY = 0.01
TOP_COUNTRIES = 5
ANOMALY_QUANTILE = 0.95
CALIBRATION_BINS = 10
TOP_PRIORITY = 25
AUC_RANGE = (0.6, 0.95)

RFM = ["Recency", "Frequency", "Monetary"]
BEHAVIOUR = ["avg_basket_value", "avg_basket_size", "unique_products"]
NUMERIC = RFM + BEHAVIOUR
COUNTRY = "DominantCountry"
LOGGED = ["Frequency", "Monetary", "avg_basket_value", "avg_basket_size", "unique_products"]
LABEL = "churn"
ID = "CustomerID"

FEATURE_GROUPS = {
    "RFM_only": RFM,
    "Behavioral_only": BEHAVIOUR,
    "RFM+Behavioral": RFM + BEHAVIOUR,
    "RFM+Behavioral+Country": RFM + BEHAVIOUR + [COUNTRY],
    "Without_Recency": RFM[1:] + BEHAVIOUR + [COUNTRY],
}
