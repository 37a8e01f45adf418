"""Quality rules: a ledger of failure bits.

Every rule is evaluated once per document; ``write_ledger`` stores its bit and the measurements as a table. Policies are
versioned bit masks applied to the stored bits afterwards, without the texts, and ablations (how many documents a policy would keep without one of its
rules) are bitwise aggregates over the ledger. All of it is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, let, words

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
#: Frequent small words of English, German, French and Spanish: running text has some of them.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "der", "die", "das", "und", "ist", "nicht",
    "le", "la", "les", "de", "et", "est", "que", "el", "los", "en", "y", "es",
)
#: The languages of these words; others have no such rule.
STOP_WORD_LANGUAGES = ("en", "de", "fr", "es")
#: Lines that begin with a bullet, end with an ellipsis, end as sentences do.
BULLET, ELLIPSIS, SENTENCE = r"^[ \t]*[-*\u2022]", r"(\.\.\.|\u2026)[\x20\x09-\x0D]*$", r"[.!?\x22\u201D\u00BB][\x20\x09-\x0D]*$"


@dataclass(frozen=True)
class QualityRule:
    """Fails where ``fails`` (an SQL condition over the measurements) is true; null counts as not failed."""

    name: str
    fails: str


#: Bit i of ``failed_bits`` belongs to rule i. Append new rules at the end: stored ledgers stay valid.
RULES = (
    QualityRule("few_words", "n_words < 50"),
    QualityRule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    QualityRule("many_symbols", "5 * n_symbols > n_words"),
    QualityRule("duplicate_lines", "10 * n_dup_lines > 5 * n_lines AND n_dup_lines >= 3"),
    QualityRule("short_words", "word_chars < 2 * n_words"),
    QualityRule("long_words", "word_chars > 20 * n_words"),
    QualityRule("few_letters", "10 * n_letter_words < 7 * n_words"),
    QualityRule("few_stop_words", "n_stop_words < 2"),
    QualityRule("bullet_lines", "10 * n_bullet_lines > 9 * n_lines"),
    QualityRule("ellipsis_lines", "10 * n_ellipsis_lines > 3 * n_lines AND n_ellipsis_lines >= 3"),
    QualityRule("open_lines", "10 * n_sentence_lines < n_lines AND n_lines >= 5"),
)
BASE = ("few_words", "repeated_words")
#: Versioned policies: the rules that each enforces.
POLICIES = {
    "v1": BASE,
    "v2": (*BASE, "many_symbols", "duplicate_lines", "short_words", "long_words"),
    "v3": tuple(r.name for r in RULES[:11]),
}
CURRENT = "v3"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words", "n_stop_words", "n_bullet_lines", "n_ellipsis_lines", "n_sentence_lines",
)


def mask(names, rules=RULES) -> int:
    bit = {r.name: 1 << i for i, r in enumerate(rules)}
    return sum(bit[n] for n in names)


def repeat_words(array: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the document, the first occurrence included.

    Windows are sorted by hash with their position, so that equal ones are neighbours; linear memory, no pairs.
    """
    window = lambda w: F.transform(
        F.sequence(F.lit(1), F.size(w) - 2),
        lambda i: F.struct(F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)).alias("h"), i.alias("p")),
    )
    at = lambda s, i: F.get(s, i).getField("h")
    starts = lambda s: F.array_sort(
        F.transform(F.filter(s, lambda x, i: (x["h"] == at(s, i - 1)) | (x["h"] == at(s, i + 1))), lambda x: x["p"])
    )
    # sorted starts: each covers 3 words less the overlap with the start before
    covered = lambda p: F.aggregate(
        p,
        F.struct(F.lit(0).alias("n"), F.lit(-9).alias("last")),
        lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")),
        lambda a: a["n"].cast("long"),
    )
    found = let(F.sort_array(window(array)), lambda s: covered(starts(s)))
    return F.when(F.size(array) < 3, F.lit(0).cast("long")).otherwise(found)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """The id with ``MEASURES``, all long. Lines are lines with a word; letter words have a letter of any script.

    A null or empty text measures zero throughout. Repeated rows each get a row; an empty table gives none. With ``lang_col``
    n_stop_words is null where the language is null or none of ``STOP_WORD_LANGUAGES``; without it all texts are taken as theirs.
    """
    known = F.lit(True) if lang_col is None else F.col(lang_col).isin(*STOP_WORD_LANGUAGES)
    text = docs.select(F.col(id_col).alias(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("__text"), known.alias("__known"))
    lines = lambda t: F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    count = lambda array, holds: F.size(F.filter(array, holds))
    facts = let(
        words(F.col("__text"), SPACE),
        lambda w: F.struct(
            F.size(w).alias("n_words"),
            repeat_words(w).alias("n_repeat_words"),
            count(w, lambda x: x.rlike(r"\p{L}")).alias("n_letter_words"),
            F.when(F.col("__known"), count(w, lambda x: ascii_lower(x).isin(*STOP_WORDS))).alias("n_stop_words"),
        ),
    )
    by_line = let(
        lines(F.col("__text")),
        lambda x: F.struct(
            F.size(x).alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
            count(x, lambda y: y.rlike(BULLET)).alias("n_bullet_lines"),
            count(x, lambda y: y.rlike(ELLIPSIS)).alias("n_ellipsis_lines"),
            count(x, lambda y: y.rlike(SENTENCE)).alias("n_sentence_lines"),
        ),
    )
    measured = text.select(
        F.col(id_col).alias("__id"),
        facts.alias("__w"),
        by_line.alias("__l"),
        F.length(F.translate("__text", BLANKS, "")).alias("word_chars"),
        (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).alias("n_symbols"),
    ).select("__id", "__w.*", "__l.*", "word_chars", "n_symbols")
    return measured.select(F.col("__id").alias(id_col), *[F.col(c).cast("long").alias(c) for c in MEASURES])


def ledger(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """Measurements and ``failed_bits`` of each row of ``docs``.

    A null or empty text measures zero throughout (so it fails ``few_words``). Repeated rows each get a row; an empty
    table gives none. Other columns aren't read, so their names can't clash. ``lang_col``: see ``measure``.
    """
    bits = F.lit(0).cast("long")
    for i, r in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(docs, id_col, text_col, lang_col).withColumn("failed_bits", bits)


def write_ledger(docs: DataFrame, path: str, rules=RULES, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """The ledger of ``docs``, written to ``path`` as Parquet and read from there: policies and ablations don't see the texts again."""
    ledger(docs, rules, id_col, text_col, lang_col).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def apply_policy(book: DataFrame, names, rules=RULES) -> DataFrame:
    """The ledger with ``kept``: none of the policy's bits is set."""
    return book.withColumn("kept", F.col("failed_bits").bitwiseAND(F.lit(mask(names, rules)).cast("long")) == 0)


def ablations(book: DataFrame, policies=POLICIES, rules=RULES) -> DataFrame:
    """(policy, without, n_kept): what each policy keeps, whole (``without`` null) and with each of its rules left out."""
    counts, rows = [], []
    for version, names in policies.items():
        for left_out in (None, *names):
            m = mask([n for n in names if n != left_out], rules)
            col = f"c{len(rows)}"
            counts.append(F.count_if(F.col("failed_bits").bitwiseAND(F.lit(m).cast("long")) == 0).alias(col))
            rows.append(F.struct(F.lit(version).alias("policy"), F.lit(left_out).cast("string").alias("without"), F.col(col).alias("n_kept")))
    return book.agg(*counts).select(F.inline(F.array(*rows)))


def keep_quality(docs: DataFrame, names=POLICIES[CURRENT], rules=RULES, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, columns unchanged; bits are worked out in the same scan.

    Null and empty texts go if the policy has ``few_words``. Repeated rows stay or go together; an empty table gives none.
    For several policies over the same documents write the ledger once and join its ids.
    """
    columns = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__doc"))
    flat = packed.select("__doc", F.col(f"__doc.`{id_col}`").alias("__id"), F.col(f"__doc.`{text_col}`").alias("__body"), F.col(f"__doc.`{lang_col}`" if lang_col else "__doc").alias("__lang"))
    book = ledger(flat.select(F.struct("__doc", "__id").alias("__key"), "__body", "__lang"), rules, "__key", "__body", "__lang" if lang_col else None)
    return apply_policy(book, names, rules).filter("kept").select("__key.__doc.*").select(*[f"`{c}`" for c in columns])
