"""Names of derived columns and label texts.

Fixed values: downstream tables rely on these exact spellings.
"""

from __future__ import annotations

ROLLING = "Rolling_{column}"
CUMULATIVE = "Acumulacion_{column}"
RANK = "Rank_{column}"
MINMAX = "MinMax_{column}"
ZSCORE = "Zscore_{column}"
GUARDED_ZSCORE = "scaler_{column}"
GUARDED_MINMAX = "minmax_{column}"
NORMALIZED = "{column}_normalize"
CATEGORY = "Categoria_{column}"
THRESHOLD = "{column}_diferiencia"
FILTERED_TOTAL = "Total_Edad"
BY_OPERATION = "{op}_{column}"

LOW_LABEL = "Bajo"
HIGH_LABEL = "Alto"

LABEL_THRESHOLD = 50
SUM_LIMIT = 50


def derived(pattern: str, column: str, op: str = "") -> str:
    return pattern.format(column=column, op=op)
