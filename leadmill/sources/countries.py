"""The country dimension: every spelling of a country, by lookup key."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.functions.countries import country_key

# Names and other spellings of frequent countries: name | alpha-2 | alpha-3 | others.
# Other tables are given as a file or a list, see ``load_countries``.
_DEFAULT = """
Argentina|AR|ARG|
Australia|AU|AUS|Commonwealth of Australia
Austria|AT|AUT|Oesterreich;Österreich
Belgium|BE|BEL|
Brazil|BR|BRA|Brasil
Bulgaria|BG|BGR|
Canada|CA|CAN|
Chile|CL|CHL|
China|CN|CHN|People's Republic of China;PRC;Mainland China
Colombia|CO|COL|
Croatia|HR|HRV|Hrvatska
Cyprus|CY|CYP|
Czechia|CZ|CZE|Czech Republic
Denmark|DK|DNK|Danmark
Egypt|EG|EGY|
Estonia|EE|EST|
Finland|FI|FIN|Suomi
France|FR|FRA|French Republic
Germany|DE|DEU|Deutschland;Federal Republic of Germany
Greece|GR|GRC|Hellas
Hong Kong|HK|HKG|Hong Kong SAR
Hungary|HU|HUN|
India|IN|IND|Bharat;Republic of India
Indonesia|ID|IDN|
Ireland|IE|IRL|Republic of Ireland;Eire
Israel|IL|ISR|
Italy|IT|ITA|Italia
Japan|JP|JPN|Nippon
Kenya|KE|KEN|
Latvia|LV|LVA|
Lithuania|LT|LTU|
Luxembourg|LU|LUX|
Malaysia|MY|MYS|
Malta|MT|MLT|
Mexico|MX|MEX|México
Netherlands|NL|NLD|The Netherlands;Holland
New Zealand|NZ|NZL|Aotearoa
Nigeria|NG|NGA|
Norway|NO|NOR|Norge
Pakistan|PK|PAK|
Peru|PE|PER|Perú
Philippines|PH|PHL|The Philippines
Poland|PL|POL|Polska
Portugal|PT|PRT|
Romania|RO|ROU|
Saudi Arabia|SA|SAU|Kingdom of Saudi Arabia;KSA
Singapore|SG|SGP|
Slovakia|SK|SVK|Slovak Republic
Slovenia|SI|SVN|
South Africa|ZA|ZAF|Republic of South Africa;RSA
South Korea|KR|KOR|Korea;Republic of Korea;Korea, Republic of
Spain|ES|ESP|España
Sweden|SE|SWE|Sverige
Switzerland|CH|CHE|Schweiz;Suisse
Taiwan|TW|TWN|
Thailand|TH|THA|
Trinidad and Tobago|TT|TTO|
Turkey|TR|TUR|Türkiye;Turkiye
Ukraine|UA|UKR|
United Arab Emirates|AE|ARE|UAE;Emirates
United Kingdom|GB|GBR|UK;Great Britain;Britain;England;Scotland;Wales;Northern Ireland
United States|US|USA|United States of America;America;US of A;The United States
Vietnam|VN|VNM|Viet Nam
"""

# Names of ISO 3166-1 entries that differ from the display names, and other common names.
_NAMES = """
BO|Bolivia|Plurinational State of Bolivia
BN|Brunei|Brunei Darussalam
CD|Democratic Republic of the Congo|DR Congo;DRC;Congo, Democratic Republic of the;Zaire
CG|Republic of the Congo|Congo;Congo Republic
CI|Côte d'Ivoire|Ivory Coast;Cote d'Ivoire
CV|Cape Verde|Cabo Verde
FM|Micronesia|Federated States of Micronesia
IR|Iran|Islamic Republic of Iran;Persia
KP|North Korea|DPRK;Democratic People's Republic of Korea
LA|Laos|Lao PDR;Lao People's Democratic Republic
MD|Moldova|Republic of Moldova
MK|North Macedonia|Macedonia
MM|Myanmar|Burma
MO|Macao|Macau;Macao SAR
PS|Palestine|Palestinian Territories;State of Palestine
RU|Russia|Russian Federation
SY|Syria|Syrian Arab Republic
SZ|Eswatini|Swaziland
TL|Timor-Leste|East Timor
TZ|Tanzania|United Republic of Tanzania
VA|Vatican City|Holy See
VE|Venezuela|Bolivarian Republic of Venezuela
"""

# Bytes of spellings up to which the dimension is promised to fit a broadcast.
MAX_BROADCAST_BYTES = 32 << 20


def _listed() -> dict[str, tuple[str, list[str]]]:
    """By two-letter code the names written down here: the one to use, and others."""
    found = {}
    for line in _DEFAULT.strip().splitlines():
        name, alpha2, _, others = line.split("|")
        found[alpha2] = name, [a for a in others.split(";") if a]
    for line in _NAMES.strip().splitlines():
        alpha2, name, others = line.split("|")
        found[alpha2] = name, [a for a in others.split(";") if a]
    return found


_iso: list[dict] = []


def default_countries(spark: SparkSession) -> list[dict]:
    """All entries of ISO 3166-1: codes and English names as the Java platform has them, with the
    names written down here before those."""
    if not _iso:
        locale, listed = spark._jvm.java.util.Locale, _listed()
        for alpha2 in locale.getISOCountries():
            place = locale("", alpha2)
            shown = place.getDisplayCountry(locale.ENGLISH)
            plain = shown.replace(" & ", " and ").replace("St. ", "Saint ").replace("’", "'")
            name, others = listed.get(alpha2, (plain, []))
            _iso.append({"canonical_name": name, "alpha2": alpha2, "alpha3": place.getISO3Country(),
                         "aliases": [*others, plain, shown]})
    return _iso


def load_countries(path: str | Path) -> list[dict]:
    """Read a JSON list of ``{canonical_name, alpha2, alpha3, aliases}``, a settings file."""
    return json.loads(Path(path).read_text(encoding="utf-8"))


def spellings(entries: list[dict]) -> list[tuple[str, str, int]]:
    """``(spelling, canonical name, load order)``, blanks left out."""
    listed = []
    for order, entry in enumerate(entries):
        name = entry["canonical_name"]
        names = [name, entry.get("alpha2"), entry.get("alpha3"), *(entry.get("aliases") or [])]
        listed += [(spelling, name, order) for spelling in names if spelling]
    return listed


def country_dimension(spark: SparkSession, entries: list[dict] | None = None) -> DataFrame:
    """``(country_key, canonical_country)``, one row per key; a later entry wins a clash.

    The hint is given only while the spellings, whose size is known here, are bounded; a bigger
    table is left for Catalyst to place by its size.
    """
    listed = spellings(default_countries(spark) if entries is None else entries)
    size = sum(len(spelling) + len(name) for spelling, name, _ in listed) * 4
    columns = list(zip(*listed)) if listed else [[], [], []]
    table = pa.table({
        "spelling": pa.array(columns[0], pa.string()),
        "canonical": pa.array(columns[1], pa.string()),
        "load_order": pa.array(columns[2], pa.int32()),
    })
    dimension = (
        spark.createDataFrame(table)
        .groupBy(country_key("spelling").alias("country_key"))
        .agg(F.max_by("canonical", "load_order").alias("canonical_country"))
    )
    return F.broadcast(dimension) if size <= MAX_BROADCAST_BYTES else dimension


# Columns of a file of countries; ``load_order`` may be absent or null.
TABLE_SCHEMA = "canonical_name string, alpha2 string, alpha3 string, aliases array<string>, load_order bigint"


def read_country_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Countries from JSON files of an object a line, which stay split.

    ``later`` says which of two entries wins: by ``load_order``, those without one before all others, and
    among equals by file name and place in the file. A line that is no such object ends the job, as does one
    without a name.
    """
    read = spark.read.schema(TABLE_SCHEMA).option("mode", "FAILFAST").json(path)
    # Numbers given while reading ascend within a split.
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    name = F.when(F.trim("canonical_name") != "", F.col("canonical_name")).otherwise(
        F.raise_error(F.lit("a country without a canonical_name")))
    return read.select(name.alias("canonical_name"), "alpha2", "alpha3", "aliases",
                       F.struct(F.col("load_order"), place.alias("place")).alias("later"))


def country_table(entries: DataFrame, write: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The dimension of countries that come as a table: ``canonical_name``, ``alpha2``, ``alpha3``,
    ``aliases`` and ``later``, by which a later entry wins a clash.

    Spellings are exploded and reduced by key with partial results, so a spelling that very many
    entries share costs a row per task. The dimension is written and measured; it is broadcast only if its
    keys and names are bounded, else joined by a shuffle.
    """
    names = F.concat(F.array("canonical_name", "alpha2", "alpha3"), F.coalesce("aliases", F.array().cast("array<string>")))
    spelled = entries.select("canonical_name", "later", F.explode(names).alias("spelling")).filter("spelling <> ''")
    dimension = write(
        spelled.groupBy(country_key("spelling").alias("country_key"))
        .agg(F.max_by("canonical_name", F.struct("later", "canonical_name")).alias("canonical_country")), "country_dimension")
    size = dimension.agg(F.sum(F.octet_length("country_key") + F.octet_length("canonical_country"))).first()[0] or 0
    return F.broadcast(dimension) if size * 4 <= MAX_BROADCAST_BYTES else dimension
