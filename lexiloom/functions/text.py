"""Column expressions over text and tokens. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Unicode whitespace and word characters, written out so that other engines can state the same classes.
SPACE = r"\t\n\x0B\f\r\x85\p{Z}"
WORD = r"\p{L}\p{M}\p{N}\p{Pc}"

# Cleaning patterns, units and stop words of the Indic cleaner.
INDIC_LEADING = r"""^[•'"$\-.\s]+"""
INDIC_UNITS = ("करोड़", "लाख", "रुपए", "रूपए", "साल", "वर्ष", "मिनट", "हज़ार", "घंटे")
INDIC_PARENTHESES = r"\(.*?\)"
INDIC_SENTENCE_END = r"[।!?]\s*"
INDIC_STOP_WORDS = ("का", "की", "के", "में", "से", "को", "पर", "ने", "एक", "और")
DEVANAGARI = r"ऀ-ॿ"


def english_stop_words(spark: SparkSession) -> list[str]:
    """The English list that Spark ML ships; pass any other list to :func:`filter_tokens`."""
    return list(spark._jvm.org.apache.spark.ml.feature.StopWordsRemover.loadDefaultStopWords("english"))


def clean_basic(text: Column, punctuation: bool = True, numbers: bool = True) -> Column:
    """Lower-case, drop punctuation and digits, collapse whitespace, strip. Most characters pass the short class alone."""
    drop = ([rf"[^{WORD}{SPACE}]"] if punctuation else []) + ([r"\p{Nd}"] if numbers else [])
    out = F.lower(text)
    if drop:
        out = F.regexp_replace(out, rf"(?=[^a-z ])(?:{'|'.join(drop)})", "")
    return F.trim(F.regexp_replace(out, rf"[{SPACE}]+", " "))


def clean_minimal(text: Column) -> Column:
    """Lower-case and drop punctuation; whitespace and digits stay."""
    return F.regexp_replace(F.lower(text), rf"[^{WORD}{SPACE}]", "")


def unit_pattern(units: Sequence[str] = INDIC_UNITS) -> str:
    """A number followed by one of ``units``."""
    return rf"\p{{Nd}}+[{SPACE}]*(?:{'|'.join(units)})"


def mixed_pattern(script: str = DEVANAGARI) -> str:
    """A run of Latin letters meeting a run of ``script``, either order, with other characters between."""
    return rf"[a-zA-Z]++[^{script}]*+[{script}]+|[{script}]+[^{script}]*[a-zA-Z]+"


def _indic_wrapped(text: Column, units: Sequence[str]) -> Column:
    led = F.regexp_replace(text, "(?U)" + INDIC_LEADING, "")
    wrapped = F.regexp_replace(led, unit_pattern(units), "__$0__")
    return F.regexp_replace(wrapped, INDIC_PARENTHESES, "")


def clean_indic(text: Column, units: Sequence[str] = INDIC_UNITS) -> Column:
    """Drop leading symbols, wrap number+unit phrases once as ``__m__``, drop parentheses and sentence ends."""
    return F.regexp_replace(_indic_wrapped(text, units), "(?U)" + INDIC_SENTENCE_END, "")


def unit_phrases(text: Column, units: Sequence[str] = INDIC_UNITS) -> Column:
    """All number+unit matches, as an array."""
    led = F.regexp_replace(text, "(?U)" + INDIC_LEADING, "")
    return F.regexp_extract_all(led, F.lit(unit_pattern(units)), 0)


def mixed_phrases(text: Column, script: str = DEVANAGARI, units: Sequence[str] = INDIC_UNITS) -> Column:
    """All mixed-script matches, as an array. Rows without the script skip the scan."""
    body = _indic_wrapped(text, units)
    found = F.regexp_extract_all(body, F.lit(mixed_pattern(script)), 0)
    return F.when(body.rlike(f"[{script}]"), found).otherwise(F.array().cast("array<string>"))


def tokenize(clean: Column) -> Column:
    """Split on whitespace; empty strings are dropped."""
    return F.filter(F.split(clean, rf"[{SPACE}]+"), lambda t: t != "")


def filter_tokens(
    toks: Column, stop_words: Sequence[str] = (), min_length: int = 3, drop_numbers: bool = True
) -> Column:
    """Keep tokens that are long enough, not stop words and not all digits, which no token from ``a`` up to ``{`` is."""
    def keep(t: Column) -> Column:
        ok = F.length(t) >= min_length
        if stop_words:
            ok = ok & ~t.isin(*stop_words)
        return ok & (t.between("a", "{") | ~t.rlike(r"^\p{Nd}+$")) if drop_numbers else ok

    return F.filter(toks, keep)


def filter_tokens_indic(toks: Column) -> Column:
    """Minimum length two and the ten fixed stop words."""
    return filter_tokens(toks, INDIC_STOP_WORDS, min_length=2, drop_numbers=False)


def script_filter(toks: Column, script: str = DEVANAGARI) -> Column:
    """Keep tokens with at least one character of ``script``."""
    return F.filter(toks, lambda t: t.rlike(f"[{script}]"))


def config_label(norm: Column, dim: Column) -> Column:
    return F.concat(norm, F.lit(" (d="), dim.cast("string"), F.lit(")"))


def parse_params(stem: Column) -> Column:
    """``[hindi_]embeddings_w10_ppmi_d100`` to a struct (window, norm, dim); all null when any part fails."""
    parts = F.split(stem, "_")
    skip = F.when(F.lower(parts[0]) == "hindi", F.lit(1)).otherwise(F.lit(0))

    def part(i: int) -> Column:
        return F.get(parts, skip + F.lit(i))

    def number(i: int) -> Column:
        return F.substring(part(i), 2, 1 << 30).try_cast("int")

    ok = number(1).isNotNull() & part(2).isNotNull() & number(3).isNotNull()
    return F.struct(
        F.when(ok, number(1)).alias("window"),
        F.when(ok, part(2)).alias("norm"),
        F.when(ok, number(3)).alias("dim"),
    )


def template_fill(template: Column, role: Column) -> Column:
    """Put ``role`` into ``{role}``; a template without ``[MASK]`` is an error."""
    guard = F.raise_error(F.lit("template must contain [MASK]"))
    return F.when(F.contains(template, F.lit("[MASK]")), F.replace(template, F.lit("{role}"), role)).otherwise(guard)
