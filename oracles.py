"""DuckDB statements that compute what the registered queries do, written on their own.

Regular expressions are RE2 here (no look-around, ASCII ``\\b``), so they differ from Spark's.
"""

from __future__ import annotations

from leadmill.driver_tables import (
    ATTEMPT,
    ATTEMPT_COLUMNS,
    COUNTRY_ALIASES,
    COUNTRY_COLUMNS,
    COUNTRY_TEXT,
    FIRM,
    LEAD_COLUMNS,
    RULE_KEYWORDS,
    RULE_TEXT,
)

# What the engine must agree with, written down once more: a changed constant there is a difference here.
CRM_NAMES = {
    "first_name": "FirstName", "last_name": "LastName", "email": "Email", "company": "Company", "title": "Title",
    "phone": "Phone", "source": "LeadSource", "country": "Country", "industry": "Industry__c",
    "company_size": "Company_Size__c", "company_domain": "Company_Domain__c", "lead_score": "Lead_Score__c",
    "score_reasons": "Score_Reasons__c", "lead_date": "Lead_Date__c", "source_row_number": "Source_Row_Number__c",
}
_TOKENS = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', "
           "'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'")
FREE_MAIL_DOMAINS = ["gmail.com", "hotmail.com", "icloud.com", "outlook.com", "yahoo.com"]
# The rules' names, points and words in the order they are tried.
_FUNCTIONS = """
creative_operations 18: creative operations, creative ops, design ops, brand ops, studio operations, production operations, marketing operations
brand_and_creative_leadership 16: creative director, art director, design director, brand director, head of creative, head of brand
content_and_production 14: creative producer, content producer, producer, studio manager, production manager, content operations
marketing_and_campaigns 12: brand marketing, content marketing, performance marketing, campaign manager, growth marketing, demand generation
asset_management_and_workflows 15: digital asset manager, asset manager, dam, librarian, content librarian, workflow manager, approval manager
sales 4: sales, account executive, business development, sdr, bdr, revenue
engineering 3: engineer, developer, software, data
"""
_SENIORITIES = """
executive 20: chief, ceo, cto, cfo, coo, cmo, cro, president, founder
vp_head_director 15: vp, vice president, head, director
manager_lead 8: manager, lead
"""
_INDUSTRY_POINTS = ("retail 12, ecommerce 12, media 10, entertainment 10, agency 10, consumer_goods 9, fashion 9, software 8, "
                    "saas 8, technology 7, education 5, nonprofit 5, healthcare 4, manufacturing 3")
_SIZE_POINTS = "enterprise 15, mid_market 10, small_business 5"


def _rules_of(lines: str) -> list[dict]:
    rules = []
    for line in lines.strip().splitlines():
        head, words = line.split(": ")
        name, score = head.split(" ")
        rules.append({"name": name, "score": int(score), "keywords": words.split(", ")})
    return rules


def _points_of(listed: str) -> dict[str, int]:
    return {name: int(points) for name, points in (p.split(" ") for p in listed.split(", "))}


SCORING_RULES = {
    "base_score": 0, "score_bounds": {"min": 0, "max": 100},
    "title_function_scores": _rules_of(_FUNCTIONS), "seniority_scores": _rules_of(_SENIORITIES),
    "industry_scores": _points_of(_INDUSTRY_POINTS), "company_size_scores": _points_of(_SIZE_POINTS),
    "penalties": {"free_email_domain": 5, "missing_company": 8, "failed_enrichment": 6},
}

# Countries that occur in the leads: the name to use, and how they are written there.
_COUNTRIES = """
United States: US; usa; u.s.; United States of America
Canada: CA
United Kingdom: Great Britain; UK
France: France
Morocco: MA; Morocco
Bangladesh: BD; bangladesh
Iceland: IS; Iceland
Qatar: QAT; qatar
Côte d'Ivoire: Côte d'Ivoire; ivory coast
Vietnam: Viet Nam; VNM
Democratic Republic of the Congo: DR Congo; COD
Russia: Russian Federation; RUS
Bosnia and Herzegovina: Bosnia & Herzegovina; bosnia and herzegovina
New Zealand: NZL
Netherlands: Holland; nl
Turkey: Türkiye; TUR
Saint Lucia: St. Lucia; saint lucia
South Korea: Korea, Republic of; KR
Czechia: Czech  Republic; cz
Germany: Deutschland
Zimbabwe: ZWE; zimbabwe
"""

_SPACE = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _text(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '{_SPACE}+', ' ', 'g')), '')"


def _literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _title_case(c: str) -> str:
    parts = rf"regexp_extract_all({c}, '\p{{L}}+|\P{{L}}')"
    return f"array_to_string(list_transform({parts}, lambda p: upper(p[1]) || lower(p[2:])), '')"


def _key(c: str) -> str:
    s = f"replace(replace({c}, 'ß', 'ss'), '&', ' and ')"
    s = f"replace(lower({s}), 'ς', 'σ')"
    s = f"regexp_replace({s}, '[.''’]', '', 'g')"
    return rf"trim(regexp_replace(replace({s}, '_', ' '), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def _date(c: str) -> str:
    def tried(*formats: str) -> str:
        listed = ", ".join(f"'{f}'" for f in formats)
        return f"try_strptime({c}, [{listed}])"

    # Without a weekday in front, a time behind, and with a name of September that all formats know.
    c = rf"regexp_replace(regexp_replace({c}, '(,? |T)\d{{1,2}}:\d{{2}}(:\d{{2}})?( ?[AaPp][Mm])?$', ''), '^(Mon|Tue|Wed|Thu|Fri|Sat|Sun), ', '')"
    c = f"regexp_replace({c}, '^Sept ', 'Sep ')"
    full = f"regexp_full_match({c}, "
    return rf"""strftime(cast(CASE
      WHEN {full}'\d{{1,2}}/\d{{1,2}}/\d{{4}}') THEN
        CASE WHEN cast(split_part({c}, '/', 1) AS int) > 12 THEN {tried('%d/%m/%Y')}
             ELSE {tried('%m/%d/%Y')} END
      WHEN {full}'\d{{1,2}}/\d{{1,2}}/\d{{2}}') THEN {tried('%m/%d/%y')}
      WHEN {full}'\d{{4}}-\d{{1,2}}-\d{{1,2}}') THEN {tried('%Y-%m-%d')}
      WHEN {full}'\d{{4}}/\d{{1,2}}/\d{{1,2}}') THEN {tried('%Y/%m/%d')}
      WHEN {full}'\d{{1,2}}-[A-Za-z]+-\d{{4}}') THEN {tried('%d-%b-%Y', '%d-%B-%Y')}
      WHEN {full}'\d{{1,2}}-[A-Za-z]+-\d{{2}}') THEN {tried('%d-%b-%y')}
      WHEN {full}'\d{{1,2}}-\d{{1,2}}-\d{{4}}') THEN {tried('%d-%m-%Y', '%m-%d-%Y')}
      WHEN {full}'[A-Za-z]+ \d{{1,2}}, \d{{4}}') THEN {tried('%b %d, %Y')}
      WHEN {full}'\d{{1,2}} [A-Za-z]+ \d{{4}}') THEN {tried('%d %b %Y')}
      END AS date), '%Y-%m-%d')"""


def _phone(c: str) -> str:
    cut = rf"trim(string_split_regex({c}, '(?i)\b(?:ext|ext\.|x)\s*\d+\b')[1])"
    digits = rf"nullif(regexp_replace({cut}, '\D', '', 'g'), '')"
    return f"CASE WHEN starts_with({cut}, '+') THEN '+' || {digits} ELSE {digits} END"


def _domain(c: str) -> str:
    return f"CASE WHEN contains({c}, '@') THEN lower(string_split({c}, '@')[-1]) END"


def _contains(c: str, *words: str) -> str:
    return "(" + " OR ".join(f"contains(lower({c}), '{w}')" for w in words) + ")"


_INDUSTRY = f"""CASE WHEN company IS NULL THEN NULL
    WHEN {_contains('company', 'agency', 'studio')} THEN 'agency'
    WHEN {_contains('company', 'media', 'publisher')} THEN 'media'
    WHEN {_contains('company', 'software', 'saas')} THEN 'software'
    WHEN {_contains('title', 'creative', 'brand')} THEN 'media' ELSE 'unknown' END"""
_SIZE = f"""CASE WHEN company IS NULL THEN NULL
    WHEN {_contains('company', 'global', 'international', 'systems')} THEN 'enterprise'
    WHEN {_contains('company', 'labs', 'media', 'agency', 'studio')} THEN 'mid_market'
    ELSE 'small_business' END"""
_COMPANY_DOMAIN = r"regexp_replace(lower(company), '[^\p{L}\p{N}]', '', 'g') || '.com'"


def _rule(c: str, rules: list[dict], value: str) -> str:
    whens = []
    for rule in rules:
        words = "|".join(w.replace(".", r"\.") for w in rule["keywords"])
        shown = _literal(rule["name"]) if value == "name" else str(rule["score"])
        whens.append(rf"WHEN regexp_matches({c}, '\b(?:{words})\b') THEN {shown}")
    return "CASE " + " ".join(whens) + " END"


def _points(c: str, points: dict) -> str:
    whens = " ".join(f"WHEN {_literal(k)} THEN {v}" for k, v in points.items())
    return f"CASE lower({c}) {whens} ELSE 0 END"


def _scored(table: str) -> str:
    r = SCORING_RULES
    p = r["penalties"]
    free = ", ".join(map(_literal, FREE_MAIL_DOMAINS))
    return f"""SELECT *,
      cast(greatest({r['score_bounds']['min']}, least({r['score_bounds']['max']},
        {r['base_score']} + coalesce(fs, 0) + coalesce(ss, 0) + ip + sp
        - CASE WHEN free THEN {p['free_email_domain']} ELSE 0 END
        - CASE WHEN company IS NULL THEN {p['missing_company']} ELSE 0 END
        - CASE WHEN enrichment_status = 'failed' THEN {p['failed_enrichment']} ELSE 0 END
      )) AS int) AS lead_score,
      nullif(concat_ws('; ', fn, sn,
        CASE WHEN ip <> 0 THEN 'industry_' || industry END,
        CASE WHEN sp <> 0 THEN 'company_size_' || company_size END,
        CASE WHEN free THEN 'penalty_free_email_domain' END,
        CASE WHEN company IS NULL THEN 'penalty_missing_company' END,
        CASE WHEN enrichment_status = 'failed' THEN 'penalty_failed_enrichment' END), '')
        AS score_reasons
    FROM (SELECT *,
        {_rule('lower(title)', r['title_function_scores'], 'name')} AS fn,
        {_rule('lower(title)', r['title_function_scores'], 'score')} AS fs,
        {_rule('lower(title)', r['seniority_scores'], 'name')} AS sn,
        {_rule('lower(title)', r['seniority_scores'], 'score')} AS ss,
        {_points('industry', r['industry_scores'])} AS ip,
        {_points('company_size', r['company_size_scores'])} AS sp,
        coalesce({_domain('email')} IN ({free}), false) AS free
      FROM {table})"""


_SPELLINGS = ", ".join(
    f"({_literal(spelling)}, {_literal(line.split(': ')[0])}, {order})"
    for order, line in enumerate(_COUNTRIES.strip().splitlines())
    for spelling in line.split(": ")[1].split("; ")
)
_ATTEMPTS = ", ".join(f"{sql} AS {c}" for c, sql in ATTEMPT_COLUMNS.items())


def _answers(most: int) -> str:
    """The first answer of each company within some attempts, else the last failure."""
    return f"""SELECT company, arg_min(struct_pack(
          industry := CASE WHEN enrichment_status = 'enriched' THEN industry END,
          company_size := CASE WHEN enrichment_status = 'enriched' THEN company_size END,
          company_domain := CASE WHEN enrichment_status = 'enriched' THEN company_domain END,
          enrichment_status := enrichment_status, provider_record_found := provider_record_found,
          error_message := error_message, attempts := attempt),
        CASE WHEN enrichment_status = 'failed' THEN 100 - attempt ELSE attempt END) AS r
      FROM attempts WHERE attempt <= {most} GROUP BY company"""


_LEADS = ", ".join(f"{sql} AS {c}" for c, sql in LEAD_COLUMNS.items())
_FIELDS = (
    "source_row_number, full_name, first_name, last_name, raw_email, email, title, company, "
    "phone, source, country, lead_date"
)


def _longest(c: str) -> str:
    return (f"arg_max({c}, (length({c}), -source_row_number)) "
            f"FILTER (WHERE {c} IS NOT NULL) AS {c}")


def _first(c: str) -> str:
    return f"arg_min({c}, source_row_number) FILTER (WHERE {c} IS NOT NULL) AS {c}"


# Common table expressions, each using only those above it.
_STEPS = {
    "raw": f"SELECT {_LEADS} FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey",
    "txt": f"""SELECT source_row_number, {_text('name')} AS full_name, {_text('email')} AS raw_email,
      {_text('title')} AS title, {_text('company')} AS company, {_text('phone')} AS phone_text,
      {_text('source')} AS source, {_text('country')} AS country_text,
      {_text('created_at')} AS date_text FROM raw""",
    "dim": f"""SELECT {_key('trim(spelling)')} AS country_key, arg_max(canonical, load_order) AS canonical
      FROM (VALUES {_SPELLINGS}) AS v(spelling, canonical, load_order) GROUP BY 1""",
    "norm": rf"""SELECT source_row_number, full_name,
      {_title_case("string_split(full_name, ' ')[1]")} AS first_name,
      CASE WHEN contains(full_name, ' ') THEN {_title_case("string_split(full_name, ' ')[-1]")} END
        AS last_name,
      raw_email,
      CASE WHEN regexp_full_match(raw_email, '[^@\s]+@[^@\s]+\.[^@\s]+') THEN lower(raw_email) END
        AS email,
      title, company, {_phone('phone_text')} AS phone, source,
      coalesce(canonical, country_text) AS country, country_text,
      {_key('country_text')} AS country_key, canonical, {_date('date_text')} AS lead_date
      FROM txt LEFT JOIN dim ON dim.country_key = {_key('country_text')}""",
    "accepted": f"SELECT {_FIELDS} FROM norm WHERE email IS NOT NULL",
    "invalid": f"SELECT {_FIELDS}, 'missing_or_invalid_email' AS drop_reason FROM norm WHERE email IS NULL",
    "merged": f"""SELECT email, min(source_row_number) AS source_row_number,
      min(lead_date) AS lead_date,
      arg_max(phone, (starts_with(phone, '+'), length(phone), -source_row_number))
        FILTER (WHERE phone IS NOT NULL) AS phone,
      {_longest('full_name')}, {_longest('title')}, {_longest('company')},
      {_first('source')}, {_first('country')}, {_first('raw_email')}, {_first('first_name')},
      {_first('last_name')} FROM accepted GROUP BY email""",
    "duplicates": f"""SELECT {_FIELDS}, 'duplicate_email_merged' AS drop_reason FROM (
      SELECT *, row_number() OVER (PARTITION BY email ORDER BY source_row_number) AS place
      FROM accepted) WHERE place > 1""",
    "rejected": "SELECT * FROM invalid UNION ALL BY NAME SELECT * FROM duplicates",
    "enriched": f"""SELECT *, {_INDUSTRY} AS industry, {_SIZE} AS company_size,
      {_COMPANY_DOMAIN} AS company_domain,
      CASE WHEN company IS NULL THEN 'not_found' ELSE 'enriched' END AS enrichment_status
      FROM merged""",
    "attempts": f"""SELECT company, attempt, {_ATTEMPTS} FROM (
      SELECT {FIRM} AS company, {ATTEMPT} AS attempt, min(c_custkey) AS k FROM customer c GROUP BY ALL)""",
    "answers_of_two": _answers(2),
    "answers_of_three": _answers(3),
    "answered": """SELECT merged.*, r.industry AS industry, r.company_size AS company_size,
      r.company_domain AS company_domain, r.enrichment_status AS enrichment_status, r.attempts AS attempts,
      r.provider_record_found AS provider_record_found, r.error_message AS error_message
      FROM merged LEFT JOIN answers_of_two ON answers_of_two.company = merged.company""",
    "scored": _scored("enriched"),
    "scored_answers": _scored("answered"),
    "clean": """SELECT source_row_number, first_name, last_name, full_name, email, title, company,
      phone, source, country, lead_date, industry, company_size, company_domain, enrichment_status,
      lead_score, score_reasons,
      email IS NOT NULL AND last_name IS NOT NULL AND company IS NOT NULL AS salesforce_ready
      FROM scored""",
}
_ENRICHMENT = "industry, company_size, company_domain, enrichment_status"
_CRM = ", ".join(f"{c} AS {name}" for c, name in CRM_NAMES.items())


def _with(sql: str) -> str:
    steps = ", ".join(f"{name} AS ({body})" for name, body in _STEPS.items())
    return f"WITH {steps} {sql}"


_QUERIES = {
    "prepare_leads": """SELECT source_row_number, name AS full_name, cast(NULL AS varchar) AS first_name,
      cast(NULL AS varchar) AS last_name, email AS raw_email, email, title, company, phone, source,
      country, created_at AS lead_date FROM raw""",
    "normalize_text": "SELECT source_row_number, full_name, raw_email, title, company, source FROM txt",
    "normalize_email": "SELECT source_row_number, raw_email, email FROM norm",
    "normalize_phone": "SELECT source_row_number, phone FROM norm",
    "split_name": "SELECT source_row_number, full_name, first_name, last_name FROM norm",
    "normalize_date": "SELECT source_row_number, lead_date FROM norm",
    "country_dimension": """SELECT country_key, canonical AS canonical_country, count(*) AS leads
      FROM norm WHERE country_text IS NOT NULL GROUP BY ALL""",
    "country_table": f"""SELECT source_row_number, coalesce(canonical, country) AS country FROM
      (SELECT cast(o_orderkey + 1 AS bigint) AS source_row_number, {COUNTRY_TEXT} AS country FROM orders) t
      LEFT JOIN (SELECT {_key('spelling')} AS country_key, arg_max(canonical_name, load_order) AS canonical FROM
        (SELECT canonical_name, load_order, unnest([canonical_name, alpha2, alpha3, {', '.join(COUNTRY_ALIASES)}]) AS spelling FROM
          (SELECT *, {', '.join(f'{sql} AS {c}' for c, sql in COUNTRY_COLUMNS.items())} FROM customer))
        WHERE spelling <> '' GROUP BY 1) d ON d.country_key = {_key('country')}""",
    "normalize_country": "SELECT source_row_number, country_text, country FROM norm",
    "email_domain": f"SELECT source_row_number, email, {_domain('email')} AS email_domain FROM norm",
    "normalize_leads": f"SELECT {_FIELDS} FROM norm",
    "lead_completeness": "SELECT source_row_number, " + " + ".join(
        f"(CASE WHEN {c.strip()} IS NOT NULL THEN 1 ELSE 0 END)"
        for c in _FIELDS.split(",")[1:]) + " AS completeness FROM norm",
    "accepted_leads": "SELECT * FROM accepted",
    "rejected_invalid": "SELECT * FROM invalid",
    "merge_leads": f"SELECT {_FIELDS} FROM merged",
    "rejected_duplicates": "SELECT * FROM duplicates",
    "rejected_leads": "SELECT * FROM rejected",
    "enrich_industry": f"SELECT source_row_number, company, title, {_INDUSTRY} AS industry FROM merged",
    "enrich_size": f"SELECT source_row_number, company, {_SIZE} AS company_size FROM merged",
    "enrich_domain": f"SELECT source_row_number, company, {_COMPANY_DOMAIN} AS company_domain FROM merged",
    "enriched_leads": f"SELECT {_FIELDS}, {_ENRICHMENT} FROM enriched",
    "provider_enrichment": f"""SELECT {_FIELDS}, {_ENRICHMENT}, provider_record_found, error_message,
      attempts FROM answered""",
    "provider_scores": """SELECT source_row_number, enrichment_status, lead_score, score_reasons
      FROM scored_answers""",
    "shared_requests": """SELECT source_row_number, accepted.company AS company, r.industry AS industry,
      r.company_size AS company_size, r.company_domain AS company_domain, r.enrichment_status AS enrichment_status
      FROM accepted LEFT JOIN answers_of_three a ON a.company = accepted.company""",
    "numbered_orders": "SELECT row_number() OVER () AS source_row_number, o_orderkey FROM orders",
    "quoted_records": f"""SELECT doc_id, CASE WHEN source IN ({_TOKENS}) THEN NULL ELSE source END AS source,
      CASE WHEN text IN ({_TOKENS}) THEN NULL ELSE length(text) END AS n_chars,
      CASE WHEN text IN ({_TOKENS}) THEN NULL ELSE md5(text) END AS text_md5 FROM documents""",
    "lead_balance": """SELECT 'raw' AS result, count(*) AS leads FROM raw
      UNION ALL SELECT 'clean', count(DISTINCT email) FROM norm
      UNION ALL SELECT 'rejected', count(*) - count(DISTINCT email) FROM norm""",
    "rule_match": f"""SELECT source_row_number, title,
      {_rule('lower(title)', SCORING_RULES['title_function_scores'], 'name')} AS title_function,
      {_rule('lower(title)', SCORING_RULES['seniority_scores'], 'name')} AS seniority FROM norm""",
    "score_leads": "SELECT source_row_number, title, lead_score, score_reasons FROM scored",
    "clean_leads": "SELECT * FROM clean",
    "crm_export": f"SELECT {_CRM} FROM clean WHERE salesforce_ready",
    "crm_export_all": f"SELECT {_CRM} FROM clean",
    "summary_scalars": """SELECT (SELECT count(*) FROM raw) AS raw_rows, count(*) AS clean_rows,
      (SELECT count(*) FROM rejected) AS rejected_rows,
      count(*) FILTER (WHERE salesforce_ready) AS salesforce_ready_rows,
      count(*) FILTER (WHERE NOT salesforce_ready) AS clean_but_not_salesforce_ready_rows,
      round(coalesce(avg(lead_score), 0.0), 9) AS average_lead_score,
      round(coalesce(count(*) FILTER (WHERE enrichment_status = 'enriched')
        / nullif((SELECT count(*) FROM raw), 0) * 100, 0.0), 9) AS percent_enriched_from_raw
      FROM clean""",
    "status_counts": "SELECT enrichment_status, count(*) AS leads FROM clean GROUP BY 1",
    "reason_counts": "SELECT drop_reason, count(*) AS leads FROM rejected GROUP BY 1",
    "report_counts": """SELECT 'enrichment_status' AS kind, enrichment_status AS label, count(*) AS leads FROM clean GROUP BY ALL
      UNION ALL SELECT 'rejection_reason', drop_reason, count(*) FROM rejected GROUP BY ALL""",
    "replayed_requests": """SELECT r.company AS company, r.leads AS leads,
      CASE WHEN s.answered THEN s.industry.v WHEN length(r.company) % 3 <> 0 AND length(r.company) % 2 = 0 THEN 'media' END AS industry,
      CASE WHEN s.answered THEN s.company_size.v END AS company_size,
      CASE WHEN s.answered THEN s.status WHEN coalesce(length(r.company), 0) % 3 = 0 THEN 'failed'
        WHEN length(r.company) % 2 = 1 THEN 'not_found' ELSE 'enriched' END AS enrichment_status,
      cast(CASE WHEN s.answered THEN s.tried ELSE coalesce(s.tried, 0) + CASE WHEN coalesce(length(r.company), 0) % 3 = 0 THEN 2 ELSE 1 END END AS bigint) AS tries
      FROM (SELECT company, count(*) AS leads FROM merged GROUP BY company) r
      LEFT JOIN (SELECT company, max(attempt) AS tried, coalesce(bool_or(enrichment_status <> 'failed'), false) AS answered,
          arg_min(enrichment_status, attempt) FILTER (WHERE enrichment_status <> 'failed') AS status,
          arg_min(struct_pack(v := CASE WHEN enrichment_status = 'enriched' THEN industry END), attempt)
            FILTER (WHERE enrichment_status <> 'failed') AS industry,
          arg_min(struct_pack(v := CASE WHEN enrichment_status = 'enriched' THEN company_size END), attempt)
            FILTER (WHERE enrichment_status <> 'failed') AS company_size
        FROM attempts WHERE attempt <= 2 GROUP BY company) s ON s.company IS NOT DISTINCT FROM r.company""",
    "indexed_rules": f"""SELECT source_row_number, t.text AS text, min(place) AS place FROM
      (SELECT {LEAD_COLUMNS["source_row_number"]} AS source_row_number, {RULE_TEXT} AS text
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) t
      LEFT JOIN (SELECT text, min(place) AS place FROM
        (SELECT DISTINCT text, unnest(string_split(text, ' ')) AS word FROM (SELECT DISTINCT {RULE_TEXT} AS text
          FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)) w
        JOIN ({" UNION ALL ".join(f"SELECT {place} AS place, {keyword} AS keyword FROM {name} WHERE {some}"
                                  for name, (place, keyword, some) in RULE_KEYWORDS.items())}) k
          ON split_part(keyword, ' ', 1) = word AND contains(' ' || text || ' ', ' ' || keyword || ' ')
        GROUP BY text) m ON m.text = t.text GROUP BY ALL""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in _QUERIES.items()}
