"""Column names, value sets and business constants of the churn data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values ---------------------------------------------------------------------------------

RAW = T.StructType([
    T.StructField("customerID", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("SeniorCitizen", T.IntegerType()),
    T.StructField("Partner", T.StringType()),
    T.StructField("Dependents", T.StringType()),
    T.StructField("tenure", T.IntegerType()),
    T.StructField("PhoneService", T.StringType()),
    T.StructField("MultipleLines", T.StringType()),
    T.StructField("InternetService", T.StringType()),
    T.StructField("OnlineSecurity", T.StringType()),
    T.StructField("OnlineBackup", T.StringType()),
    T.StructField("DeviceProtection", T.StringType()),
    T.StructField("TechSupport", T.StringType()),
    T.StructField("StreamingTV", T.StringType()),
    T.StructField("StreamingMovies", T.StringType()),
    T.StructField("Contract", T.StringType()),
    T.StructField("PaperlessBilling", T.StringType()),
    T.StructField("PaymentMethod", T.StringType()),
    T.StructField("MonthlyCharges", T.DoubleType()),
    T.StructField("TotalCharges", T.StringType()),  # blank for new customers, so text until cleaned
    T.StructField("Churn", T.StringType()),
])

CLEANED = T.StructType([
    T.StructField("customerID", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("SeniorCitizen", T.IntegerType()),
    T.StructField("Partner", T.StringType()),
    T.StructField("Dependents", T.StringType()),
    T.StructField("tenure", T.IntegerType()),
    T.StructField("MonthlyCharges", T.DoubleType()),
    T.StructField("TotalCharges", T.DoubleType()),
    T.StructField("Churn", T.IntegerType()),
    T.StructField("tenure_group", T.StringType()),
    T.StructField("RevenueCategory", T.StringType()),
    T.StructField("AnnualRevenue", T.DoubleType()),
    T.StructField("LoyaltyScore", T.DoubleType()),
    T.StructField("Contract", T.StringType()),
    T.StructField("PaymentMethod", T.StringType()),
    T.StructField("InternetService", T.StringType()),
])

ACCESS_LOG = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("username", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("ip", T.StringType()),
])
LOG_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

RAW_TABLE = "customer_churn_raw"
CLEANED_TABLE = "customer_churn_cleaned"

YES_NO = {"Yes": 1, "No": 0}
GENDER = {"Male": 1, "Female": 0}
YES_NO_COLUMNS = ["Partner", "Dependents", "PhoneService", "PaperlessBilling"]
LABEL_COLUMNS = ["Contract", "InternetService", "PaymentMethod"]  # kept as text beside their dummies

_ADD_ON = ["No", "No internet service", "Yes"]
LEVELS = {  # one-hot columns and their values
    "MultipleLines": ["No", "No phone service", "Yes"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    "OnlineSecurity": _ADD_ON,
    "OnlineBackup": _ADD_ON,
    "DeviceProtection": _ADD_ON,
    "TechSupport": _ADD_ON,
    "StreamingTV": _ADD_ON,
    "StreamingMovies": _ADD_ON,
    "Contract": ["Month-to-month", "One year", "Two year"],
    "PaymentMethod": ["Bank transfer (automatic)", "Credit card (automatic)",
                      "Electronic check", "Mailed check"],
}

TENURE_EDGES = [0, 12, 24, 48, 72]
TENURE_LABELS = ["0-1 Year", "1-2 Years", "2-4 Years", "4-6 Years"]

REVENUE_CUTS = [("Low", 35), ("Medium", 70)]  # below the cut; at or above the last one is "High"
REVENUE_LABELS = ["Low", "Medium", "High"]

RISK_EDGES = [-0.001, 0.35, 0.65, 1.001]
RISK_LABELS = ["Low", "Medium", "High"]
CHURN_THRESHOLD = 0.5
FORM_MAX_TENURE = 72

FEATURES = [
    "SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges", "gender_encoded",
    "Partner_encoded", "Dependents_encoded", "PhoneService_encoded",
    "PaperlessBilling_encoded", "AnnualRevenue", "LoyaltyScore",
]
LABEL = "Churn"
KEY = "customerID"

CHURN_DIMENSIONS = ["Contract", "InternetService", "PaymentMethod", "gender",
                    "SeniorCitizen", "Partner", "Dependents"]
AT_RISK_COLUMNS = ["customerID", "ChurnProbability", "ChurnRisk", "Contract", "InternetService",
                   "PaymentMethod", "MonthlyCharges", "tenure", "OfferTitle", "OfferDiscount"]

OFFERS = [  # id, title, description, discount, action, priority
    ("CONTRACT_UPGRADE", "Contract Upgrade Discount",
     "Switch to a 1-year contract and get 20% off your monthly bill for 6 months.",
     "20%", "Sales team to call and offer contract upgrade", 1),
    ("TECHSUPPORT_BUNDLE", "Free Tech Support Bundle",
     "Complimentary TechSupport + OnlineSecurity add-on for 3 months.",
     "Free add-on", "Auto-activate support bundle on account", 2),
    ("AUTOPAY_CASHBACK", "Auto-Pay Cashback Reward",
     "Switch to automatic payment and receive ₹200 cashback on next bill.",
     "₹200 cashback", "Send SMS with auto-pay setup link", 3),
    ("LOYALTY_UPGRADE", "Loyalty Service Upgrade",
     "As a valued long-term customer, enjoy a free service tier upgrade for 6 months.",
     "Free upgrade", "Apply service upgrade automatically", 2),
    ("SENIOR_PLAN", "Senior Customer Special Plan",
     "Exclusive senior plan with 25% reduced monthly charge and dedicated support.",
     "25%", "Assign dedicated customer care agent", 1),
    ("STREAMING_BUNDLE", "Entertainment Bundle",
     "Add StreamingTV + StreamingMovies at 50% off for 3 months.",
     "50% for 3 months", "Send activation link via email", 3),
    ("RETENTION_CALL", "Priority Retention Call",
     "High-risk customer flagged for immediate personal outreach by retention specialist.",
     "Custom offer", "Escalate to retention team — call within 24 hours", 1),
    ("STANDARD_LOYALTY", "Loyalty Appreciation Reward",
     "Thank you for being with us. Enjoy ₹100 bill credit this month.",
     "₹100 credit", "Apply bill credit automatically", 4),
]
