"""A messy lead table derived from the order and customer tables, one lead per order.

The expressions use only functions spelled alike in Spark and DuckDB, so the oracle derives
its leads from the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.operators.provider import ProviderResponse, TransientProviderError
from leadmill.sources.leads import spread

# Companies with a name of their own, which stored answers of a provider are about.
FIRM = (
    "concat('Firm ', cast(c.c_custkey % 500 as string),"
    " split_part('| Labs| Media||Global| Software', '|', cast(c.c_custkey % 6 + 1 as int)))"
)

LEAD_COLUMNS = {
    "source_row_number": "cast(o.o_orderkey + 1 as bigint)",
    "name": (
        "nullif(split_part('alice anderson|  BOB   JONES |carol|o''neil mary-jane smith||"
        "d. van der berg|éloise O''BRIEN|Prince|ÅSA öberg|jean-luc  PICARD|Dr. Ngozi Okafor|li|"
        "maria del mar  ruiz|x Æ a-12|ZOË|tom  o''HARA jr.|Müller', '|', cast(o.o_orderkey % 17 + 1 as int)), '')"
    ),
    "email": (
        "CASE WHEN o.o_orderkey % 29 = 0 THEN NULL"
        " WHEN o.o_orderkey % 11 = 0 THEN split_part("
        "'missing-at-symbol.com|emilychen@yahoo|carol@|@|a b@c.io', '|',"
        " cast(o.o_orderkey % 5 + 1 as int))"
        " WHEN o.o_orderkey % 3 = 1 THEN 'Info@BigCustomer.com'"
        " WHEN o.o_orderkey % 7 = 0 THEN concat('  USER', cast(c.c_custkey as string), '@',"
        " split_part('Gmail.com|Acme.co|YAHOO.com|startup.io|business.co.uk', '|',"
        " cast(c.c_custkey % 5 + 1 as int)), ' ')"
        " ELSE concat('user', cast(c.c_custkey as string), '@',"
        " split_part('gmail.com|acme.co|yahoo.com|startup.io|business.co.uk', '|',"
        " cast(c.c_custkey % 5 + 1 as int))) END"
    ),
    "title": (
        "nullif(split_part('Creative Operations Manager|product lead  |CEO|Vice President|Sr. Eng|"
        "Software  Engineer||head of sales|Digital Asset Manager|Madam Leader|Brand Director|"
        "Data Analyst|Creative Producer|Founder & CRO|VP, Growth Marketing|Studio Manager|SDR|chief of staff|"
        "Leadership Coach|Content Librarian', '|', cast(o.o_orderkey % 20 + 1 as int)), '')"
    ),
    "company": (
        f"CASE WHEN o.o_orderkey % 2 = 0 THEN {FIRM} ELSE "
        "nullif(split_part('Acme Studio|GlobalTech|air inc|Air Inc||Northwind  Media|Startup.io|"
        "   |Hyper Software|Initech Labs|!!!', '|',"
        " cast((c.c_custkey + o.o_orderkey % 3) % 11 + 1 as int)), '') END"
    ),
    "phone": (
        "nullif(split_part('(123) 456-7890|+1 800 555 1212|call me|5551212||"
        "+1 (416) 555-0101 ext 9|5550101x9|555 0101 ext. 22|(+1) 555 0199', '|',"
        " cast(o.o_orderkey % 9 + 1 as int)), '')"
    ),
    "source": (
        "nullif(split_part('Referral|Website Visitor|linkedin|  Product   Signup ||Event', '|',"
        " cast(o.o_orderkey % 6 + 1 as int)), '')"
    ),
    "country": (
        "nullif(split_part('US|usa|u.s.|United States of America|CA|Great Britain|UK||"
        "  Wakanda   Republic |France|MA|Morocco|BD|bangladesh|IS|Iceland|QAT|qatar|Côte d''Ivoire|ivory coast|"
        "Viet Nam|VNM|DR Congo|COD|Russian Federation|RUS|Bosnia & Herzegovina|bosnia and herzegovina|NZL|"
        "Holland|nl|Türkiye|TUR|St. Lucia|saint lucia|Korea, Republic of|KR|Czech  Republic|cz|"
        "Deutschland|ZWE|zimbabwe', '|', cast(o.o_orderkey % 46 + 1 as int)), '')"
    ),
    "created_at": (
        "CASE o.o_orderkey % 17"
        " WHEN 0 THEN concat(cast(year(o.o_orderdate) as string), '-',"
        " lpad(cast(month(o.o_orderdate) as string), 2, '0'), '-',"
        " lpad(cast(day(o.o_orderdate) as string), 2, '0'))"
        " WHEN 1 THEN concat(lpad(cast(month(o.o_orderdate) as string), 2, '0'), '/',"
        " lpad(cast(day(o.o_orderdate) as string), 2, '0'), '/',"
        " cast(year(o.o_orderdate) as string))"
        " WHEN 2 THEN concat(lpad(cast(day(o.o_orderdate) as string), 2, '0'), '-',"
        " substr('JanFebMarAprMayJunJulAugSepOctNovDec',"
        " cast(3 * month(o.o_orderdate) - 2 as int), 3), '-', cast(year(o.o_orderdate) as string))"
        " WHEN 3 THEN concat(cast(year(o.o_orderdate) as string), '/',"
        " cast(month(o.o_orderdate) as string), '/', cast(day(o.o_orderdate) as string))"
        " WHEN 4 THEN concat(lpad(cast(day(o.o_orderdate) as string), 2, '0'), '-',"
        " lpad(cast(month(o.o_orderdate) as string), 2, '0'), '-',"
        " cast(year(o.o_orderdate) as string))"
        " WHEN 5 THEN concat(cast(day(o.o_orderdate) as string), '/',"
        " cast(month(o.o_orderdate) as string), '/', cast(year(o.o_orderdate) as string))"
        " WHEN 6 THEN concat(cast(o.o_orderkey % 20 + 1 as string), ' days ago')"
        " WHEN 7 THEN '02/30/2024'"
        " WHEN 8 THEN concat(cast(month(o.o_orderdate) as string), '/',"
        " cast(day(o.o_orderdate) as string), '/', cast(year(o.o_orderdate) as string), ' 14:22')"
        " WHEN 9 THEN concat(cast(13 + o.o_orderkey % 15 as string), '/10/2024 10:00')"
        " WHEN 10 THEN concat(cast(month(o.o_orderdate) as string), '/', cast(day(o.o_orderdate) as string),"
        " '/', substr(cast(year(o.o_orderdate) as string), 3, 2))"
        " WHEN 11 THEN concat(cast(day(o.o_orderdate) as string), '-',"
        " substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(3 * month(o.o_orderdate) - 2 as int), 3), '-24')"
        " WHEN 12 THEN concat(cast(day(o.o_orderdate) as string), '-Mar-2025 10:00:00')"
        " WHEN 13 THEN concat(cast(year(o.o_orderdate) as string), '-03-05 07:05 PM')"
        " WHEN 14 THEN concat('Sept ', cast(day(o.o_orderdate) as string), ', ', cast(year(o.o_orderdate) as string))"
        " WHEN 15 THEN concat('Wed, ', lpad(cast(day(o.o_orderdate) as string), 2, '0'), ' Feb 2025')"
        " ELSE NULL END"
    ),
}

# The contract's names of the columns above.
RAW_NAMES = {
    "name": "Name",
    "email": "Email",
    "title": "Title",
    "company": "Company",
    "phone": "Phone",
    "source": "Source",
    "country": "Country",
    "created_at": "Created At",
}


def raw_leads(spark: SparkSession, tables: str) -> DataFrame:
    """One raw lead per order, under the contract's column names."""
    orders = _spread(spark.read.parquet(f"{tables}/orders.parquet")).alias("o")
    customer = spark.read.parquet(f"{tables}/customer.parquet").alias("c")
    joined = orders.join(customer, F.expr("o.o_custkey = c.c_custkey"))
    return joined.select(
        *[F.expr(sql).alias(RAW_NAMES.get(c, c)) for c, sql in LEAD_COLUMNS.items()]
    )


def _spread(rows: DataFrame) -> DataFrame:
    """Rows of a file that one task reads, dealt out by key; bigger tables stay where they are read."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return spread(rows, cores if rows.rdd.getNumPartitions() < cores else None, "o_orderkey")


# Attempts to enrich the firms, as a provider that was asked earlier left them: of the customers with a
# firm and a number of attempt, the one with the smallest key decides what came back.
ATTEMPT_COLUMNS = {
    "industry": "split_part('media|software|retail|agency', '|', cast(k % 4 + 1 as int))",
    "company_size": "split_part('enterprise|mid_market|small_business', '|', cast(k % 3 + 1 as int))",
    "company_domain": "concat(replace(lower(company), ' ', ''), '.example')",
    "enrichment_status": "CASE WHEN k % 3 = 1 THEN 'failed' WHEN k % 11 = 0 THEN 'not_found' ELSE 'enriched' END",
    "provider_name": "'stored'",
    "provider_record_found": "k % 3 <> 1 AND k % 11 <> 0",
    "error_message": "CASE WHEN k % 3 = 1 THEN concat('busy ', cast(attempt as string)) END",
    "attempts": "attempt",
}
ATTEMPT = "cast(floor(c.c_custkey / 500) as int) % 4 + 1"


def stored_attempts(spark: SparkSession, tables: str) -> DataFrame:
    """``company``, ``attempt`` and the ``response``, which has no values where it failed."""
    customer = spark.read.parquet(f"{tables}/customer.parquet").alias("c")
    first = customer.groupBy(F.expr(FIRM).alias("company"), F.expr(ATTEMPT).alias("attempt")).agg(
        F.min("c_custkey").alias("k"))
    values = first.withColumns({c: F.expr(sql) for c, sql in ATTEMPT_COLUMNS.items()})
    answered = {c: F.when(F.col("enrichment_status") == "enriched", F.col(c))
                for c in ("industry", "company_size", "company_domain")}
    return values.withColumns(answered).select("company", "attempt", F.struct(*ATTEMPT_COLUMNS).alias("response"))


class SecondRound:
    """A provider that knows companies with a name of even length, and is busy for every third length."""

    provider_name = "second round"

    def enrich(self, request: dict) -> ProviderResponse:
        size = len(request["company"] or "")
        if size % 3 == 0:
            raise TransientProviderError("busy again")
        status = "not_found" if size % 2 else "enriched"
        return ProviderResponse("media" if status == "enriched" else None, None, None, status, self.provider_name, status == "enriched")


# Texts in which thousands of rules look for a firm, a desk or a title, and their keywords; the place of
# a rule is its number. Both from the same tables.
RULE_TEXT = f"concat(coalesce(lower(nullif(trim({LEAD_COLUMNS['title']}), '')), 'no title'), ' at ', lower({FIRM}), ' desk ', cast(o.o_orderkey % 9000 as string))"
RULE_KEYWORDS = {
    "orders": ("cast(o_orderkey * 2 + 1 as int)", "concat('desk ', cast(o_orderkey as string))", "o_orderkey < 5000"),
    "customer": ("cast(c_custkey * 3 + 2 as int)", f"lower({FIRM.replace('c.c_custkey', 'c_custkey')})", "c_custkey % 7 = 0"),
}


def rule_texts(spark: SparkSession, tables: str) -> DataFrame:
    """``source_row_number`` and ``text``, one for each order."""
    orders = _spread(spark.read.parquet(f"{tables}/orders.parquet")).alias("o")
    customer = spark.read.parquet(f"{tables}/customer.parquet").alias("c")
    return orders.join(customer, F.expr("o.o_custkey = c.c_custkey")).select(
        F.expr(LEAD_COLUMNS["source_row_number"]).alias("source_row_number"), F.expr(RULE_TEXT).alias("text"))


def rule_keywords(spark: SparkSession, tables: str) -> DataFrame:
    """``place`` and ``keyword`` of thousands of rules."""
    parts = [spark.read.parquet(f"{tables}/{name}.parquet").filter(some).select(
        F.expr(place).alias("place"), F.expr(keyword).alias("keyword")) for name, (place, keyword, some) in RULE_KEYWORDS.items()]
    return parts[0].unionByName(parts[1])


def csv_of_texts(spark: SparkSession, tables: str, folder: str) -> str:
    """The documents as CSV files whose cells hold line breaks, quotes and commas; their folder."""
    texts = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text", "source")
    exact = {"quoteAll": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    texts.write.options(header=True, **exact).csv(folder)
    return folder


# A large country table of clashing spellings, an entry for each customer; later entries have greater load orders.
COUNTRY_COLUMNS = {
    "canonical_name": "concat('Land ', cast(c_custkey as string))",
    "alpha2": "CASE WHEN c_custkey % 5 <> 0 THEN concat('L', cast(c_custkey % 800 as string)) END",
    "alpha3": "CASE WHEN c_custkey % 3 = 0 THEN concat('x.', cast(c_custkey % 2000 as string)) ELSE '' END",
    "load_order": "cast(c_custkey * 7919 % 1000003 as bigint)",
}
COUNTRY_ALIASES = [
    "concat('Region of ', cast(c_custkey % 700 as string))",
    "concat('  NORTH & South-', cast(c_custkey % 3000 as string), '.')",
    "CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'Everyland' END",
]
# How leads spell them.
COUNTRY_TEXT = (
    "CASE cast(o_orderkey % 6 as int) WHEN 0 THEN concat('region OF ', cast(o_custkey % 900 as string))"
    " WHEN 1 THEN concat('North and South ', cast(o_custkey % 4000 as string)) WHEN 2 THEN concat('l', cast(o_custkey % 1000 as string))"
    " WHEN 3 THEN concat('X', cast(o_custkey % 2500 as string)) WHEN 4 THEN 'every.land'"
    " ELSE concat('LAND-', cast(o_custkey as string)) END"
)


def country_files(spark: SparkSession, tables: str, folder: str) -> str:
    """The country table as JSON files; their folder."""
    customer = spark.read.parquet(f"{tables}/customer.parquet")
    customer.select(*[F.expr(sql).alias(c) for c, sql in COUNTRY_COLUMNS.items()],
                    F.array(*[F.expr(sql) for sql in COUNTRY_ALIASES]).alias("aliases")).write.json(folder)
    return folder


def country_texts(spark: SparkSession, tables: str) -> DataFrame:
    """``source_row_number`` and ``country``, one for each order."""
    orders = _spread(spark.read.parquet(f"{tables}/orders.parquet"))
    return orders.select(F.expr("cast(o_orderkey + 1 as bigint)").alias("source_row_number"), F.expr(COUNTRY_TEXT).alias("country"))
