"""Fixed values that must equal the original pipeline's for the same results.

Kept together and in their natural order so they are easy to audit.
"""

# --- fixed values: result and severity tags -------------------------------
RESULT_SUCCESS = "Success"
SEVERITY_ERROR = "Error"
SEVERITY_INFO = "Info"

# --- fixed values: header-check issue names and joiner ----------------------
ISSUE_EXTRA = "ExtraColumns"
ISSUE_MISSING = "MissingColumns"
ISSUE_JOINER = "."

# --- fixed values: file disposition name parts ------------------------------
INVALID_HEADER_TAG = "InvalidColumnHeader"
EMPTY_TAG = "Empty"
ACCEPTED_EXTENSIONS = (".csv", ".txt")

# --- fixed values: call-stack joiner and log timestamp format ---------------
CALL_STACK_JOINER = " > "
LOG_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# --- fixed values: default delimiter of config / log / table text files -----
DEFAULT_DELIMITER = "|"
DEFAULT_QUALIFIER = '"'

# --- fixed values: transformation types in column configuration -------------
TRANSFORM_DIRECT = "Direct"
TRANSFORM_EXPRESSION = "Expression"
TRANSFORM_LOOKUP = "Lookup"
NATURAL_KEY_YES = "Yes"

# --- fixed values: Silver dimension names -----------------------------------
SILVER_DIMENSIONS = (
    "Account", "AccountType", "Brand", "Category", "PriceType",
    "ProductService", "Seller", "UnitOfMeasurement",
)
ACCOUNT_DIMENSION = "Account"
# Dimensions resolved through the mapping bridge, in processing order.
BRIDGE_DIMENSIONS = ("Brand", "Category", "ProductService", "Seller")

# --- fixed values: NULL tokens (the pandas read_csv defaults) ---------------
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- our own choices (not from the original) --------------------------------
# Named delimiters accepted in configuration, because a literal "|" cannot be
# stored in an unquoted "|"-delimited configuration file.
DELIMITER_NAMES = {"pipe": "|", "comma": ",", "tab": "\t", "semicolon": ";"}
# Data types a column configuration may declare.
SUPPORTED_TYPES = ("string", "int", "bigint", "double", "decimal", "date",
                   "timestamp", "boolean")
