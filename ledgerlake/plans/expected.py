"""The oracle's own values: what the reference fixes, stated a second time, so that a
changed constant of the operators turns a query red."""

from __future__ import annotations

# ---- fixed values: accounts, locks and posting rules
ALL_ACCOUNTS = [
    "trade_ar",
    "unbilled",
    "ar_ap_netting",
    "ofd_cld_120604",
    "ofd_wh_120804",
    "ofd_whv2_xm232",
    "ofd_whv2_xm297",
    "ofd_cld_14745",
    "ofd_wh_14746",
    "ofd_whv2_19846",
    "ofd_whv2_19848",
]
DERIVE_ORACLE_DEAL_TYPES = ["Upfront billing / 7.05 Standard", "Warehouse V2"]
INPUTS = ["original_invoice_amount", "payment_discount", "payment_applied_to_invoice", "other_adjustment"]
LOCKS = [
    ("Oracle", ["7.05 Auto Reversal", "Move AR to GL", "Move AR from GL", "Adjustment", "Initial setup WHv2"], None, "all"),
    ("Oracle", ["Payment application"], None, "three"),
    ("Oracle", ["Initial movement"], ["7.05 Exception", "7.05 Exception - Indirect"], "all"),
    ("NetSuite", ["Move AR to GL", "Move AR from GL", "Payment JE reclass", "Initial setup WHv2"], None, "all"),
    ("NetSuite", ["Apply to GL"], None, "three"),
]
NS = "NetSuite"
NS_ACCOUNTS = ["trade_ar", "ofd_cld_14745", "ofd_wh_14746", "ofd_whv2_19846", "ofd_whv2_19848"]
ORA_ACCOUNTS = ["trade_ar", "unbilled", "ar_ap_netting", "ofd_cld_120604", "ofd_wh_120804", "ofd_whv2_xm232", "ofd_whv2_xm297"]
# (rule, source, movement, deal type, assignee holds, adjustment type, accounts set to +A, accounts set to -A, input effect)
RULES = [
    (1, "NetSuite", "Initial movement", "Upfront", "CLOUD", "CM", ["ofd_cld_14745"], ["trade_ar"], ""),
    (2, "NetSuite", "Initial movement", "Upfront", "WAREHOUSE", "CM", ["ofd_wh_14746"], ["trade_ar"], ""),
    (3, "NetSuite", "Initial movement", "Warehouse V2", "WAREHOUSE", "CM", ["ofd_whv2_19848"], ["trade_ar"], ""),
    (4, "NetSuite", "Initial setup WHv2", "Warehouse V2", "WAREHOUSE", "JE", ["ofd_whv2_19846"], ["ofd_whv2_19848"], ""),
    (5, "NetSuite", "Payment JE reclass", "Warehouse V2", "WAREHOUSE", "JE", ["ofd_whv2_19848"], ["ofd_whv2_19846"], ""),
    (6, "NetSuite", "Apply to GL", "Upfront", "CLOUD", "Application", [], ["ofd_cld_14745"], "apply"),
    (7, "NetSuite", "Apply to GL", "Upfront", "WAREHOUSE", "Application", [], ["ofd_wh_14746"], "apply"),
    (8, "NetSuite", "Apply to GL", "Warehouse V2", "WAREHOUSE", "Application", [], ["ofd_whv2_19846"], "apply"),
    (9, "NetSuite", "Move AR to GL", "Upfront", "CLOUD", "CM", ["ofd_cld_14745"], ["trade_ar"], "null4"),
    (10, "NetSuite", "Move AR to GL", "Upfront", "WAREHOUSE", "CM", ["ofd_wh_14746"], ["trade_ar"], "null4"),
    (11, "NetSuite", "Move AR to GL", "Warehouse V2", "WAREHOUSE", "CM", ["ofd_whv2_19848"], ["trade_ar"], "null4"),
    (12, "NetSuite", "Move AR from GL", "Upfront", "CLOUD", "Manual invoice", ["trade_ar"], ["ofd_cld_14745"], "null4"),
    (13, "NetSuite", "Move AR from GL", "Upfront", "WAREHOUSE", "Manual invoice", ["trade_ar"], ["ofd_wh_14746"], "null4"),
    (14, "NetSuite", "Move AR from GL", "Warehouse V2", "WAREHOUSE", "Manual invoice", ["trade_ar"], ["ofd_whv2_19846"], "null4"),
    (15, "Oracle", "Initial movement", "Upfront billing / 7.05 Standard", "CLOUD", "AR Adjustment", ["ofd_cld_120604"], ["trade_ar"], ""),
    (16, "Oracle", "Initial movement", "Upfront billing / 7.05 Standard", "WAREHOUSE", "AR Adjustment", ["ofd_wh_120804"], ["trade_ar"], ""),
    (17, "Oracle", "Initial movement", "7.05 Exception", "CLOUD", "Rev Adj", ["ofd_cld_120604"], ["unbilled"], ""),
    (18, "Oracle", "Initial movement", "7.05 Exception", "WAREHOUSE", "Rev Adj", ["ofd_wh_120804"], ["unbilled"], ""),
    (19, "Oracle", "Initial movement", "7.05 Exception - Indirect", "CLOUD", "Rev Adj", ["ofd_cld_120604"], ["ar_ap_netting"], ""),
    (20, "Oracle", "Initial movement", "7.05 Exception - Indirect", "WAREHOUSE", "Rev Adj", ["ofd_wh_120804"], ["ar_ap_netting"], ""),
    (21, "Oracle", "Initial movement", "Warehouse V2", None, "AR Adjustment", ["ofd_whv2_xm297"], ["trade_ar"], ""),
    (22, "Oracle", "Initial setup WHv2", "Warehouse V2", None, "JE", ["ofd_whv2_xm232"], ["ofd_whv2_xm297"], ""),
    (23, "Oracle", "7.05 Auto Reversal", "7.05 Exception", "CLOUD", "Rev Adj", ["unbilled"], ["ofd_cld_120604"], ""),
    (24, "Oracle", "7.05 Auto Reversal", "7.05 Exception", "WAREHOUSE", "Rev Adj", ["unbilled"], ["ofd_wh_120804"], ""),
    (25, "Oracle", "7.05 Auto Reversal", "7.05 Exception - Indirect", "CLOUD", "Rev Adj", ["ar_ap_netting"], ["ofd_cld_120604"], ""),
    (26, "Oracle", "7.05 Auto Reversal", "7.05 Exception - Indirect", "WAREHOUSE", "Rev Adj", ["ar_ap_netting"], ["ofd_wh_120804"], ""),
    (27, "Oracle", "Payment application", "Upfront billing / 7.05 Standard", "CLOUD", "AR Adjustment", ["trade_ar"], ["ofd_cld_120604"], "paid"),
    (28, "Oracle", "Payment application", "Upfront billing / 7.05 Standard", "WAREHOUSE", "AR Adjustment", ["trade_ar"], ["ofd_wh_120804"], "paid"),
    (29, "Oracle", "Payment application", "7.05 Exception", None, "Application", [], [], "paid"),
    (30, "Oracle", "Payment application", "7.05 Exception - Indirect", None, "Application", [], [], "paid"),
    (31, "Oracle", "Payment application", "Warehouse V2", None, "AR Adjustment", ["trade_ar"], ["ofd_whv2_xm232"], "paid"),
    (32, "Oracle", "Move AR to GL", "Upfront billing / 7.05 Standard", "CLOUD", "AR Adjustment", ["ofd_cld_120604"], ["trade_ar"], "nullpaid"),
    (33, "Oracle", "Move AR to GL", "Upfront billing / 7.05 Standard", "WAREHOUSE", "AR Adjustment", ["ofd_wh_120804"], ["trade_ar"], "nullpaid"),
    (34, "Oracle", "Move AR to GL", "Warehouse V2", None, "AR Adjustment", ["ofd_whv2_xm297"], ["trade_ar"], "nullpaid"),
    (35, "Oracle", "Move AR from GL", "Upfront billing / 7.05 Standard", "CLOUD", "AR Adjustment", ["trade_ar"], ["ofd_cld_120604"], "nullpaid"),
    (36, "Oracle", "Move AR from GL", "Upfront billing / 7.05 Standard", "WAREHOUSE", "AR Adjustment", ["trade_ar"], ["ofd_wh_120804"], "nullpaid"),
    (37, "Oracle", "Move AR from GL", "Warehouse V2", None, "AR Adjustment", ["trade_ar"], ["ofd_whv2_xm232"], "nullpaid"),
]

# ---- fixed values: message texts and allowed values
AMOUNT_CHECKS = ["other_adjustment", "original_invoice_amount", "payment_discount", "payment_applied_to_invoice"]
EXC_DEAL_TYPES = ["7.05 Exception", "7.05 Exception - Indirect"]
EXC_MOVEMENTS = ["Initial movement", "7.05 Auto Reversal", "Adjustment"]
FUNDING_MODELS = ["OFD Cloud Receivables", "OFD Warehouse", "Funded Admin", "OFD Warehouse V2"]
M_COMBO = "Invalid combination of DEAL_TYPE and MOVEMENT_TYPE."
M_CRITERIA = "DEAL_ID does not meet import criteria. "
M_DEAL_NULL = "DEAL_ID cannot be null. "
M_DEAL_TYPE = "Invalid DEAL_TYPE value. "
M_DUP = "Duplicate entries. "
M_DUP_FOUND = "Duplicate entries found. "
M_FM_BAD = "Invalid FUNDING_MODEL value. "
M_FM_NULL = "FUNDING_MODEL cannot be null. "
M_GL_FMT = "GL_DATE_FOR_ADJUSTMENT invalid format. "
M_GL_NULL = 'GL_DATE_FOR_ADJUSTMENT cannot be null for MOVEMENT_TYPE as "7.05 Auto Reversal". '
M_MOVEMENT = "Invalid MOVEMENT_TYPE value. "
M_NON_V2 = "Please use Worklist Upload for Non-Warehouse V2 deals. "
M_NOT_IN_DB = "DEAL_ID does not exist in Database. "
M_NOT_MOVED = "Not all balance of DEAL_ID is moved. "
M_NO_INIT = "DEAL_ID with Initial movement does not exist."
M_NO_RECORD = "Record does not exist in Database. "
M_OFS = "Invalid OFS_PAYMENT_POSTING value. Please provide 'Yes' or 'No'. "
M_PATCH_MOVEMENT = 'Invalid MOVEMENT_TYPE value; it should only be "Initial movement" '
M_PAY_SRC = "Invalid PAYMENT_SOURCE value. "
M_RD_FMT = "Report date invalid format. "
M_RD_NULL = 'Report date cannot be null for deals with STATUS as "Standard". '
M_STATUS = "Invalid STATUS value. "
M_STATUS_NS = "Invalid STATUS value for NetSuite deal. "
M_STATUS_NULL = "Status cannot be null. "
M_STATUS_ORA = "Invalid STATUS value for Oracle deal. "
M_UPFRONT = "Please use Worklist Upload for Upfront deals. "
NS_BAD_COMBO_MOVEMENTS = ["Initial setup WHv2", "Payment JE reclass"]
NS_DEAL_TYPES = ["Upfront", "Warehouse V2"]
NS_MOVEMENTS = ["Initial movement", "Apply to GL", "Move AR to GL", "Move AR from GL", "Payment JE reclass", "Initial setup WHv2"]
NS_PAYMENT_SOURCES = ["Monthly pass-thru", "INTL instruction file", "Payment posting request", "Email"]
NS_STATUSES = ["Standard", "WIP", "Change Event", "Further Checking"]
OFS_VALUES = ["Yes", "No"]
ORA_COMBO_RULES = [
    (["Upfront billing / 7.05 Standard"], ["Initial setup WHv2", "7.05 Auto Reversal"]),
    (["7.05 Exception", "7.05 Exception - Indirect"], ["Initial setup WHv2", "Move AR to GL", "Move AR from GL"]),
    (["Warehouse v2"], ["7.05 Auto Reversal"]),
]
ORA_DEAL_TYPES = ["Upfront billing / 7.05 Standard", "7.05 Exception", "7.05 Exception - Indirect", "Warehouse V2"]
ORA_EXC_STATUSES = ["Standard", "Change Event", "Further Checking", "Exceptional move"]
ORA_MOVEMENTS = ["Initial movement", "Payment application", "Move AR to GL", "Move AR from GL", "Adjustment", "Initial setup WHv2"]
ORA_PAYMENT_SOURCES = ["Monthly pass-thru", "Payment posting request", "Email"]
ORA_PAY_STATUSES = ["Standard", "WIP", "Change Event", "Further Checking", "Exceptional move"]
PATCH_DEAL_TYPES = ["Upfront billing / 7.05 Standard", "7.05 Exception", "7.05 Exception - Indirect", "Warehouse V2", "Upfront"]
STATUS_NS_OK = ["WIP", "Standard", "Change Event", "Further Checking"]
STATUS_ORA_OK = ["WIP", "Standard", "Change Event", "Further Checking", "Exceptional move"]

# ---- fixed values: payment files
DATE_COLUMNS = ["contract_close_date", "funding_date", "assignment_date", "payment_due_date"]
REFERENCE_EXCLUSIONS = [
    ("PaymentDetails_NA_20230101_20230331_amend(excl 172629).xlsx", 172629),
    ("PaymentDetails_NA_20230901_20231031_amend(excl 181710).xlsx", 181710),
    ("PaymentDetails_NA_20181001_20181231_amend(excl 95885).xlsx", 95885),
    ("PaymentDetails_NA_20190401_20190531_amend(excl 98636).xlsx", 98636),
    ("PaymentDetails_NA_20200601_20200930_amend(excl 115944).xlsx", 115944),
]


def m_invalid(column: str) -> str:
    return "Invalid " + column + " value. "


def m_null(column: str) -> str:
    return column + " cannot be null. "
