"""Campaign-name parsing (C1–C11) as pure column expressions.

Naming convention:
``Brand-Country-Language-Product-Segment-Lifecycle-Sublifecycle-Engagement-Date``.
One projection computes every part; tokens stay an ``array<string>`` and are
searched with higher-order functions, never exploded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import col

# ---------------------------------------------------------------------------
# Campaign vocabulary, country blocklist and the country →
# language defaults.  These must equal the reference's lists for the same
# parses, so they are written out plainly here.
# ---------------------------------------------------------------------------
LIFECYCLES = ["RND", "WB", "CS", "ROC", "FD", "OTD", "CHU", "ACQ", "SL", "LFC", "LOADER"]
SEGMENTS = ["HIGH", "MID", "MED", "LOW", "VIP", "NA", "AFF", "COH1", "COH2", "COH3", "COH4"]
ENGAGEMENTS = ["NLI", "LI"]
PRODUCTS = ["SPO", "CAS", "LIVE", "ALL"]
SUBLIFECYCLES = ["J1", "J2", "J3", "BULK"]
COUNTRY_EXTRA_BLOCK = ["DAY", "A", "B", "NEW"]
LANGUAGE_DEFAULTS = {
    "TR": "TR", "ES": "ES", "CL": "ES", "EC": "ES", "MX": "ES", "AR": "ES", "CO": "ES",
    "PE": "ES", "BR": "PT", "GB": "EN", "UK": "EN", "IE": "EN", "CA": "EN", "NZ": "EN",
    "JP": "JA", "DE": "DE", "AT": "DE", "CH": "DE", "SE": "SV", "NO": "NO", "DK": "DA",
    "FI": "FI", "IT": "IT", "FR": "FR", "ONT": "EN",
}
# C15 display labels.
ENGAGEMENT_LABELS = {"LI": "Logged In", "NLI": "Not Logged In"}
PRODUCT_LABELS = {"CAS": "Casino", "SPO": "Sportsbook", "LIVE": "Live Casino", "ALL": "All Products"}

COUNTRY_BLOCKLIST = PRODUCTS + LIFECYCLES + SEGMENTS + ENGAGEMENTS + SUBLIFECYCLES + COUNTRY_EXTRA_BLOCK


def _arr(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def normalise_name(name) -> Column:
    """Upper-case, ``_`` → ``-``."""
    return F.replace(F.upper(col(name).cast("string")), F.lit("_"), F.lit("-"))


def tokens(name) -> Column:
    """Split the normalised name on ``-``; any ``WBD`` token becomes ``WB``."""
    raw = F.split(normalise_name(name), "-")
    return F.transform(raw, lambda t: F.when(t == "WBD", F.lit("WB")).otherwise(t))


def brand_tag(toks) -> Column:
    """First token, blank → ``UNKNOWN``."""
    first = F.get(col(toks), 0)
    return F.when(F.coalesce(first, F.lit("")) == "", F.lit("UNKNOWN")).otherwise(first)


def first_in(toks, vocabulary) -> Column:
    """First token that belongs to ``vocabulary``, else ``UNKNOWN``."""
    # keeps the order of the tokens, and takes no interpreted lambda per token
    hit = F.get(F.array_intersect(col(toks), _arr(vocabulary)), 0)
    return F.coalesce(hit, F.lit("UNKNOWN"))


def country(toks, tag) -> Column:
    """C4: first token after the tag that is alphabetic, 2–3 letters long, not a
    vocabulary word, not a blocklisted word and not the tag; else ``Global``."""
    block = _arr(COUNTRY_BLOCKLIST)
    tag = col(tag)
    hit = F.get(F.filter(col(toks), lambda t, i: (i > 0)
                         & t.rlike(r"^\p{L}{2,3}$")
                         & ~F.array_contains(block, t)
                         & (t != tag)), 0)
    return F.coalesce(hit, F.lit("Global"))


def language(country_col) -> Column:
    """Country → default language, else ``UNKNOWN``."""
    return F.coalesce(F.element_at(_map(LANGUAGE_DEFAULTS), col(country_col)), F.lit("UNKNOWN"))


def embedded_date(toks) -> Column:
    """The last three non-blank tokens read as ``yyyy-MM-dd`` (null if not a date)."""
    nb = F.filter(col(toks), lambda t: F.trim(t) != "")
    last3 = F.when(F.size(nb) >= 3, F.concat_ws("-", F.slice(nb, -3, 3)))
    return F.when(last3.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(last3, "yyyy-M-d"))


def data_age_days(toks, ops_date, sentinel: int | None = None) -> Column:
    """``ops_date`` minus the embedded campaign date in days.

    Internally null when there is no date; the S4-compatible sink uses −1.
    """
    age = F.datediff(col(ops_date), embedded_date(toks))
    return age if sentinel is None else F.coalesce(age, F.lit(sentinel))


def data_age_from_range_suffix(name, ops_date) -> Column:
    """Only names ending ``…-yyyy-mm-dd_yyyy-mm-dd`` carry an age; null otherwise."""
    pat = r"(\d{4}-\d{2}-\d{2})_\d{4}-\d{2}-\d{2}$"
    d = F.regexp_extract(col(name), pat, 1)
    return F.when(col(name).rlike(pat), F.datediff(col(ops_date), F.try_to_date(d, "yyyy-MM-dd")))


def core_signature(name) -> Column:
    """Strip a trailing ``yyyy-mm-dd``, then ``ddMONyyyy``, then ``yyyy-mm``."""
    s = col(name).cast("string")
    s = F.regexp_replace(s, r"[_-]\d{4}[_-]\d{2}[_-]\d{2}$", "")
    s = F.regexp_replace(s, r"[_-]\d{2}[A-Z]{3}\d{4}$", "")
    s = F.regexp_replace(s, r"[_-]\d{4}[_-]\d{2}$", "")
    return s


def campaign_signature(name) -> Column:
    """Cut at the last ``_`` when the name (``-`` read as ``_``) ends in two or
    three numeric groups and the raw name holds a ``_``."""
    s = col(name).cast("string")
    norm = F.replace(s, F.lit("-"), F.lit("_"))
    ends_numeric = norm.rlike(r"_\d+_\d+$")  # also covers the three-group case
    return F.when(ends_numeric & s.contains("_"), F.regexp_replace(s, r"_[^_]*$", "")).otherwise(s)


def strategy_signature(brand, country_col, lifecycle, engagement) -> Column:
    """``brand-country-lifecycle-engagement`` with nulls as ``UNKNOWN``."""
    parts = [F.coalesce(col(c), F.lit("UNKNOWN")) for c in (brand, country_col, lifecycle, engagement)]
    return F.concat_ws("-", *parts)


def display_lifecycle(core_sig) -> Column:
    """C11: ``RND`` if ``[-_ ]RND`` occurs, else ``WB`` if ``[-_ ]WB`` occurs, else ``UNKNOWN``."""
    u = F.upper(col(core_sig))
    return F.when(u.rlike(r"[-_ ]RND"), F.lit("RND")).when(u.rlike(r"[-_ ]WB"), F.lit("WB")) \
        .otherwise(F.lit("UNKNOWN"))


def engagement_label(c) -> Column:
    """C15."""
    return F.coalesce(F.element_at(_map(ENGAGEMENT_LABELS), col(c)), col(c))


def product_label(c) -> Column:
    """C15."""
    return F.coalesce(F.element_at(_map(PRODUCT_LABELS), col(c)), col(c))


def tokens_compact(name) -> Column:
    """C1 variant of the upsert loader: empty tokens dropped, any ``WBD`` → ``WB``."""
    return F.filter(tokens(name), lambda t: t != "")


def apply_renames(df, column: str, renames):
    """brand/client renames and merges — broadcast join to a (bounded)
    rename table ``(old, new)`` and ``coalesce(new, old)``."""
    r = renames.select(F.col("old").alias("_old"), F.col("new").alias("_new"))
    out = df.join(F.broadcast(r), df[column] == r["_old"], "left")
    return out.withColumn(column, F.coalesce(F.col("_new"), F.col(column))).drop("_old", "_new")


def reparse_unknown(df, name_col: str = "campaign"):
    """Re-extract lifecycle and engagement only where they are UNKNOWN or
    null (compact-token variant); other rows keep their values, in one pass."""
    t = tokens_compact(name_col)
    unknown_lc = F.col("extracted_lifecycle").isNull() | (F.col("extracted_lifecycle") == "UNKNOWN")
    unknown_en = F.col("extracted_engagement").isNull() | (F.col("extracted_engagement") == "UNKNOWN")
    return (df.withColumn("extracted_lifecycle", F.when(unknown_lc, first_in(t, LIFECYCLES)).otherwise(F.col("extracted_lifecycle")))
            .withColumn("extracted_engagement", F.when(unknown_en, first_in(t, ENGAGEMENTS)).otherwise(F.col("extracted_engagement"))))


def heal_ops_date(c) -> Column:
    """C20: ``2025_03_01`` → ``2025-03-01``."""
    return F.replace(col(c).cast("string"), F.lit("_"), F.lit("-"))


def parse_campaign(df, name_col: str = "campaign", ops_date_col: str = "ops_date"):
    """C1–C6 in one projection: adds tag, the five vocabulary parts, country,
    language and data age (null when the name carries no date)."""
    t = tokens(name_col)
    out = df.withColumn("_tokens", t).withColumn("tag", brand_tag("_tokens"))
    out = out.select(
        "*",
        first_in("_tokens", LIFECYCLES).alias("extracted_lifecycle"),
        first_in("_tokens", SEGMENTS).alias("extracted_segment"),
        first_in("_tokens", ENGAGEMENTS).alias("extracted_engagement"),
        first_in("_tokens", PRODUCTS).alias("extracted_product"),
        first_in("_tokens", SUBLIFECYCLES).alias("extracted_sublifecycle"),
        country("_tokens", "tag").alias("country"),
        data_age_days("_tokens", ops_date_col).alias("campaign_data_age_days"),
    )
    out = out.withColumn("extracted_language", language("country"))
    return out.drop("_tokens")
