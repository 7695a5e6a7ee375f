"""Values that have to be exactly these for results to be right."""

# --- fixed values: input contract, in declared order -----------------------------
RAW_TO_LEAD = {
    "Name": "full_name",
    "Email": "email",
    "Title": "title",
    "Company": "company",
    "Phone": "phone",
    "Source": "source",
    "Country": "country",
    "Created At": "lead_date",
}

# --- fixed values: column order of a normalised lead (after the row number) ------
LEAD_FIELDS = [
    "full_name",
    "first_name",
    "last_name",
    "raw_email",
    "email",
    "title",
    "company",
    "phone",
    "source",
    "country",
    "lead_date",
]

# --- fixed values: column order of a clean lead -----------------------------------
CLEAN_COLUMNS = [
    "source_row_number",
    "first_name",
    "last_name",
    "full_name",
    "email",
    "title",
    "company",
    "phone",
    "source",
    "country",
    "lead_date",
    "industry",
    "company_size",
    "company_domain",
    "enrichment_status",
    "lead_score",
    "score_reasons",
    "salesforce_ready",
]

# --- fixed values: CRM import names, in export order -------------------------------
CRM_NAMES = {
    "first_name": "FirstName",
    "last_name": "LastName",
    "email": "Email",
    "company": "Company",
    "title": "Title",
    "phone": "Phone",
    "source": "LeadSource",
    "country": "Country",
    "industry": "Industry__c",
    "company_size": "Company_Size__c",
    "company_domain": "Company_Domain__c",
    "lead_score": "Lead_Score__c",
    "score_reasons": "Score_Reasons__c",
    "lead_date": "Lead_Date__c",
    "source_row_number": "Source_Row_Number__c",
}

# --- fixed values: fields a lead needs before it may be imported -------------------
READY_FIELDS = ["email", "last_name", "company"]

# --- fixed values: reasons a row is dropped ----------------------------------------
BAD_EMAIL = "missing_or_invalid_email"
MERGED_DUPLICATE = "duplicate_email_merged"

# --- fixed values: enrichment states -----------------------------------------------
ENRICHED = "enriched"
NOT_FOUND = "not_found"
FAILED = "failed"
NOT_ENRICHED = "not_enriched"

# --- fixed values: mail hosts anyone can sign up to --------------------------------
FREE_MAIL_DOMAINS = ["gmail.com", "hotmail.com", "icloud.com", "outlook.com", "yahoo.com"]

# --- fixed values: words that reveal industry and size, tried in this order --------
COMPANY_INDUSTRY_WORDS = [
    ("agency", ["agency", "studio"]),
    ("media", ["media", "publisher"]),
    ("software", ["software", "saas"]),
]
TITLE_INDUSTRY_WORDS = [("media", ["creative", "brand"])]
UNKNOWN_INDUSTRY = "unknown"
COMPANY_SIZE_WORDS = [
    ("enterprise", ["global", "international", "systems"]),
    ("mid_market", ["labs", "media", "agency", "studio"]),
]
DEFAULT_COMPANY_SIZE = "small_business"

# --- fixed values: cells the CSV source reads as null ------------------------------
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: default scoring rules; the first matching rule of a list wins ---
SCORING_RULES = {
    "base_score": 0,
    "score_bounds": {"min": 0, "max": 100},
    "title_function_scores": [
        {"name": "creative_operations", "score": 18, "keywords": [
            "creative operations", "creative ops", "design ops", "brand ops",
            "studio operations", "production operations", "marketing operations"]},
        {"name": "brand_and_creative_leadership", "score": 16, "keywords": [
            "creative director", "art director", "design director", "brand director",
            "head of creative", "head of brand"]},
        {"name": "content_and_production", "score": 14, "keywords": [
            "creative producer", "content producer", "producer", "studio manager",
            "production manager", "content operations"]},
        {"name": "marketing_and_campaigns", "score": 12, "keywords": [
            "brand marketing", "content marketing", "performance marketing",
            "campaign manager", "growth marketing", "demand generation"]},
        {"name": "asset_management_and_workflows", "score": 15, "keywords": [
            "digital asset manager", "asset manager", "dam", "librarian",
            "content librarian", "workflow manager", "approval manager"]},
        {"name": "sales", "score": 4, "keywords": [
            "sales", "account executive", "business development", "sdr", "bdr", "revenue"]},
        {"name": "engineering", "score": 3, "keywords": [
            "engineer", "developer", "software", "data"]},
    ],
    "seniority_scores": [
        {"name": "executive", "score": 20, "keywords": [
            "chief", "ceo", "cto", "cfo", "coo", "cmo", "cro", "president", "founder"]},
        {"name": "vp_head_director", "score": 15, "keywords": [
            "vp", "vice president", "head", "director"]},
        {"name": "manager_lead", "score": 8, "keywords": ["manager", "lead"]},
    ],
    "company_size_scores": {"enterprise": 15, "mid_market": 10, "small_business": 5, "unknown": 0},
    "industry_scores": {
        "retail": 12, "ecommerce": 12, "media": 10, "entertainment": 10, "agency": 10,
        "consumer_goods": 9, "fashion": 9, "software": 8, "saas": 8, "technology": 7,
        "education": 5, "nonprofit": 5, "healthcare": 4, "manufacturing": 3, "unknown": 0,
    },
    "penalties": {"free_email_domain": 5, "missing_company": 8, "failed_enrichment": 6},
}
