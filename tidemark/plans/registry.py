"""All registered queries by name."""

from tidemark.plans import learning, refreshes, retail, risk, surveys

QUERIES = {
    **retail.QUERIES,
    **risk.QUERIES,
    **surveys.QUERIES,
    **learning.QUERIES,
    **refreshes.QUERIES,
}
