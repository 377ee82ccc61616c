"""Find, mask, tokenise and hide personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.text import EMAIL_PATTERN, PHONE_PATTERN

# The information types, how sure a pattern alone can be, and its pattern. Patterns use
# only syntax that Java and RE2 share. Names, street addresses and birth dates cannot be told reliably
# by a pattern; treat those counts as hints.
INFO_TYPES = {
    "PERSON_NAME": ("possible", r"(?:^|[^\p{L}])[A-Z][a-z]+ [A-Z][a-z]+"),
    "EMAIL_ADDRESS": ("likely", EMAIL_PATTERN),
    "PHONE_NUMBER": ("likely", PHONE_PATTERN),
    "STREET_ADDRESS": ("possible", r"\b\d{1,5} [A-Z][a-z]+ (?:St|Street|Ave|Avenue|Rd|Road|Blvd|Lane|Ln|Drive|Dr)\b"),
    "CREDIT_CARD_NUMBER": ("likely", r"\b\d(?:[ -]?\d){12,18}\b"),
    "US_SOCIAL_SECURITY_NUMBER": ("likely", r"\b\d{3}-\d{2}-\d{4}\b"),
    "DATE_OF_BIRTH": ("possible", r"\b(?:19|20)\d{2}-\d{2}-\d{2}\b"),
    "IP_ADDRESS": ("likely", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b"),
    "URL": ("likely", r"https?://[^\s<>]+"),
}
# What a text must hold for the pattern to match at all: a literal, or a pattern that fails fast (it begins with one
# character class). Most texts fail, and skip the information type. A gate that types share is tried once per text.
DIGIT, TWO_CAPITALS = "[0-9]", "[A-Z][a-z]+ [A-Z]"
LITERALS = {"EMAIL_ADDRESS": "@", "URL": "://"}
GATES = {"PERSON_NAME": TWO_CAPITALS, **dict.fromkeys(
    ("PHONE_NUMBER", "STREET_ADDRESS", "CREDIT_CARD_NUMBER", "US_SOCIAL_SECURITY_NUMBER", "DATE_OF_BIRTH", "IP_ADDRESS"), DIGIT)}
TOKEN_TAG = "PII_TOKEN"


def luhn_valid(number: Column) -> Column:
    """Check-digit test of the digits in a text (Luhn, US patent 2950048)."""
    digits = F.split(F.reverse(F.regexp_replace(number, "[^0-9]", "")), "")

    def weigh(d: Column, i: Column) -> Column:
        n = d.try_cast("int") * (i % 2 + 1)
        return F.coalesce(n - F.when(n > 9, 9).otherwise(0), F.lit(0))

    return F.aggregate(F.transform(digits, weigh), F.lit(0), lambda acc, x: acc + x) % 10 == 0


def passes(c: Column, info_type: str) -> Column:
    """Could the text hold the information type? Cheap, and never wrong about a no."""
    return c.contains(LITERALS[info_type]) if info_type in LITERALS else c.rlike(GATES[info_type])


def count_findings(c: Column, info_type: str, gate: Column | None = None) -> Column:
    """How often the information type occurs in a text (0 for null). ``gate`` is :func:`passes`, if it is known already."""
    pattern = INFO_TYPES[info_type][1]
    if info_type == "CREDIT_CARD_NUMBER":
        hits = F.size(F.filter(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), luhn_valid))
    else:
        hits = F.regexp_count(c, F.lit(pattern))
    return F.coalesce(F.when(passes(c, info_type) if gate is None else gate, hits), F.lit(0)).cast("bigint")


def inspect_pii(df: DataFrame, cols: list[str], info_types: list[str] | None = None, min_likelihood: str = "likely") -> DataFrame:
    """Findings per (column, information type): rows that hold one, occurrences, rows seen.

    Counts only; no text is quoted. Every row is read. All counts come from one pass and one aggregate.
    """
    chosen = [t for t in (info_types or INFO_TYPES) if min_likelihood == "possible" or INFO_TYPES[t][0] == "likely"]
    pairs = [(c, t) for c in cols for t in chosen]
    shared = [(c, g) for c in cols for g in sorted({GATES[t] for t in chosen if t in GATES})]
    gated = df.select(*cols, *[F.col(c).rlike(g).alias(f"_g{i}") for i, (c, g) in enumerate(shared)])
    gates = {(c, t): F.col(f"_g{shared.index((c, GATES[t]))}") if t in GATES else None for c, t in pairs}
    counted = gated.select(*[count_findings(F.col(c), t, gates[c, t]).alias(f"_{i}") for i, (c, t) in enumerate(pairs)])
    sums = counted.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"_{i}") > 0).alias(f"_r{i}") for i in range(len(pairs))],
        *[F.coalesce(F.sum(f"_{i}"), F.lit(0)).alias(f"_f{i}") for i in range(len(pairs))])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("info_type"), F.lit(INFO_TYPES[t][0]).alias("likelihood"),
                 F.col(f"_r{i}").alias("rows_found"), F.col(f"_f{i}").alias("findings"), F.col("_rows").alias("rows_seen"))
        for i, (c, t) in enumerate(pairs)])
    return sums.select(F.explode(rows).alias("_r")).select("_r.*")


def full_mask(c: Column, char: str = "*") -> Column:
    """Every character replaced; the length stays."""
    return F.repeat(F.lit(char), F.length(c))


def tokenise(c: Column, key: Column, iv_key: Column) -> Column:
    """Reversible token, equal for equal values.

    AES-GCM with an IV derived from the value by a keyed hash, so the IV (visible in the token) tells
    nothing without ``iv_key``. ``key`` is 16, 24 or 32 bytes.
    """
    iv = F.substring(F.unhex(F.sha2(F.concat_ws("|", F.base64(iv_key), c), 256)), 1, 12)
    sealed = F.aes_encrypt(c, key, F.lit("GCM"), F.lit("DEFAULT"), iv)
    return F.when(c.isNotNull(), F.concat(F.lit(TOKEN_TAG + ":"), F.base64(sealed)))


def untokenise(c: Column, key: Column) -> Column:
    """The value of a token; text that is not a token, or was made with another key, gives null."""
    sealed = F.unbase64(F.when(c.startswith(TOKEN_TAG + ":"), F.substring_index(c, ":", -1)))
    return F.try_aes_decrypt(sealed, key, F.lit("GCM"), F.lit("DEFAULT")).cast("string")


def deidentify(df: DataFrame, cols: list[str], mode: str = "mask", char: str = "*", key: bytes | None = None,
               iv_key: bytes | None = None) -> DataFrame:
    """Mask or tokenise columns in place. Keys are arguments; they are stored nowhere."""
    if mode == "mask":
        return df.withColumns({c: full_mask(F.col(c).cast("string"), char) for c in cols})
    if mode == "token":
        if not key or not iv_key:
            raise ValueError("mode='token' needs key and iv_key")
        k, v = F.lit(bytearray(key)), F.lit(bytearray(iv_key))
        return df.withColumns({c: tokenise(F.col(c).cast("string"), k, v) for c in cols})
    raise ValueError(f"unknown mode {mode!r}")


def reidentify(df: DataFrame, cols: list[str], key: bytes) -> DataFrame:
    return df.withColumns({c: untokenise(F.col(c), F.lit(bytearray(key))) for c in cols})


def deidentify_table(df: DataFrame, cols: list[str], target: str, findings_path: str | None = None, **options) -> DataFrame:
    """Write a de-identified copy, and on request what was found in the original."""
    if findings_path:
        inspect_pii(df, cols).write.mode("overwrite").parquet(findings_path)
    deidentify(df, cols, **options).write.mode("overwrite").parquet(target)
    return df.sparkSession.read.parquet(target)


def columns_marked_pii(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.metadata.get("pii")]


def secure_view(df: DataFrame, pii_cols: list[str] | None = None, privileged: bool = False) -> DataFrame:
    """What a reader may see: everything if privileged, else nulls in the personal-data columns.

    By default the columns whose field metadata says ``pii``. Because the projection replaces the
    column, an unprivileged plan does not even read it.
    """
    if privileged:
        return df
    hidden = set(columns_marked_pii(df) if pii_cols is None else pii_cols)
    return df.select(*[
        F.lit(None).cast(t).alias(c) if c in hidden else F.col(f"`{c}`") for c, t in df.dtypes])
