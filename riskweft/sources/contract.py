"""Column contract of the wide risk table.

Fixed values: these names and groupings are the published layout of the
credit-card default table and have to match it exactly.
"""

LABEL = "Y"
ROW_ID = "row_id"

SEMANTIC_NAMES = {
    "X1": "LIMIT_BAL", "X2": "SEX", "X3": "EDUCATION", "X4": "MARRIAGE", "X5": "AGE",
    "X6": "PAY_0", "X7": "PAY_2", "X8": "PAY_3", "X9": "PAY_4", "X10": "PAY_5", "X11": "PAY_6",
    "X12": "BILL_AMT1", "X13": "BILL_AMT2", "X14": "BILL_AMT3",
    "X15": "BILL_AMT4", "X16": "BILL_AMT5", "X17": "BILL_AMT6",
    "X18": "PAY_AMT1", "X19": "PAY_AMT2", "X20": "PAY_AMT3",
    "X21": "PAY_AMT4", "X22": "PAY_AMT5", "X23": "PAY_AMT6",
}
FEATURES = [f"X{i}" for i in range(1, 24)]
CATEGORICAL = ["X2", "X3", "X4"]
# Monthly blocks, newest month first.
DELAY = [f"X{i}" for i in range(6, 12)]
BILL = [f"X{i}" for i in range(12, 18)]
PAYMENT = [f"X{i}" for i in range(18, 24)]

MIN_ROWS = 29_000
MIN_FEATURES = 20
SEED = 42
GATES = {"roc_auc": 0.75, "f1": 0.65, "recall": 0.60}
