"""Names, labels and word lists that results are compared on."""

# --- fixed values: raw column names and their snake_case counterparts -------
RENAMES = {
    "Invoice": "invoice_id",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}
SHEET = "source_sheet"

# --- fixed values: transaction statuses --------------------------------------
INVALID_PRICE = "invalid_price"
ZERO_PRICE = "zero_price"
ZERO_QUANTITY = "zero_quantity"
MISSING_DATE = "missing_invoice_date"
CANCELLED = "cancelled"
RETURN = "return_or_adjustment"
MISSING_DESCRIPTION = "missing_description"
MISSING_CUSTOMER = "missing_customer_id"
VALID_SALE = "valid_sale"
REQUIRES_REVIEW = "requires_review"

# --- fixed values: customer segments -----------------------------------------
CHAMPIONS = "Champions"
LOYAL = "Loyal Customers"
NEW = "New Customers"
POTENTIAL_LOYALISTS = "Potential Loyalists"
AT_RISK = "At Risk"
LOST = "Lost Customers"
HIBERNATING = "Hibernating"
BIG_SPENDERS = "Big Spenders"
NEED_ATTENTION = "Need Attention"

# --- fixed values: defaults --------------------------------------------------
UNKNOWN_PRODUCT = "UNKNOWN PRODUCT"
HOME_MARKET = "United Kingdom"
OPERATIONAL_DESCRIPTIONS = (
    "MANUAL",
    "POSTAGE",
    "DOTCOM POSTAGE",
    "BANK CHARGES",
    "AMAZON FEE",
    "DISCOUNT",
)

# --- fixed values: the characters Python counts as white space ---------------
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
