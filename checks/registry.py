"""All check statements by query name."""

from checks import learning, retail, risk, surveys

CHECKS = {**retail.CHECKS, **risk.CHECKS, **surveys.CHECKS, **learning.CHECKS}
