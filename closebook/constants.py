"""Texts, codes and bounds that appear in results or are compared with data."""

from __future__ import annotations

from decimal import Decimal

# Asset classes by asset identifier.
STABLECOINS = ("ASSET_USDC", "ASSET_USDT")
LAYER_ONE_ASSETS = ("ASSET_BTC", "ASSET_ETH", "ASSET_SOL")

# Lower bounds of the valuation tiers (USD) and the least distributable reward.
INSTITUTIONAL_MIN_USD = 10_000_000
PRIME_MIN_USD = 1_000_000
MIN_DISTRIBUTION = Decimal("0.0001")

# Longest unbonding (days) of each category.
IMMEDIATE_DAYS = 0
SHORT_TAIL_DAYS = 3
MEDIUM_TAIL_DAYS = 21

# The largest difference that still ties out.
LEDGER_TOLERANCE_USD = Decimal("0.01")
REWARD_TOLERANCE = Decimal("0.0001")

# Reconciliation statuses, first one that applies wins; position = sort rank.
RECONCILIATION_STATUSES = (
    "MissingPosition",
    "FeeWithoutBalance",
    "HasPendingEvents",
    "UnbilledFees",
    "Reconciled",
)

# Ledger statuses in sort order, and the texts explaining the first two.
LEDGER_STATUSES = ("VARIANCE_DETECTED", "UNCONFIRMED", "MATCHED")
UNCONFIRMED_TEXT = "No custodian ledger reference — position not confirmed by custodian"
VARIANCE_TEXT = "Qty × Price restatement differs from computed valuation by $"

APPROVED = "APPROVED"

# Close checks and their descriptions.
CLOSE_CHECKS = {
    "reconciliation_clean": "All ReconciliationSummary rows must be Reconciled before statements ship",
    "ledger_tieout_clean": "All LedgerBalanceTieOut rows must be MATCHED before statements ship",
    "no_pending_events": "All FinancialEvents must be settled (IsPending = FALSE) before month-end close",
    "all_fees_billed": "All FeeEvents must be fully billed before month-end close",
    "no_missing_positions": "Every client/asset with activity must have a corresponding position snapshot",
    "kyc_approved_only": "Only KYC-approved clients (KycStatus = APPROVED) may receive statements",
}
SAMPLE_SIZE = 5

# Accepted codes of the source contracts.
REWARD_STATES = ("pending", "settled")
FEE_TYPES = ("custody", "staking", "trading")
BILLING_STATUSES = ("invoiced", "pending")
KYC_STATUSES = ("APPROVED", "PENDING", "SUSPENDED")

# The institution issuing statements is a parameter everywhere; this is only its default.
DEFAULT_ENTITY = "CUSTODIAN"
