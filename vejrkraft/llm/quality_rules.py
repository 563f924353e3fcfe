"""Quality rules in a short-circuit cascade, in DataFrame functions only.

The measures of a text are computed in its row, without a shuffle. Every rule is timed and counted on a
bounded sample; the cascade asks the rules in order of rejections per second, and a text that fails
one rule is not shown to the later ones. The order changes the time, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = r"\x20\x09-\x0D"
_WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # percent of the words
SAMPLE_ROWS = 200

# Each rule is true for a text that it rejects. They read the base measures and ``text``.
RULES: Mapping[str, str] = {
    # More than one symbol in ten words.
    "symbols": "10 * n_symbols > n_words",
    # Words are too short or too long on average.
    "word_length": "word_chars < 2 * n_words or word_chars > 12 * n_words",
    # More than 3 lines in 10 were there before.
    "repeated_lines": rf"10 * n_dup_lines > 3 * size(filter(split(text, '\n'), x -> x rlike '[^{_SPACE}]'))",
    # Most characters of the words are capitals, or digits.
    "capitals": r"2 * length(regexp_replace(text, '[^\\p{Lu}]+', '')) > word_chars",
    "digits": r"2 * length(regexp_replace(text, '[^0-9]+', '')) > word_chars",
}


def _repeated_words(hashes: Column, begins: Column) -> Column:
    """Words in windows that stand twice or more: ``begins`` holds (hash, place) sorted by hash."""
    again = F.filter(
        begins,
        lambda x, i: (F.get(begins, i - 1)["h"] == x["h"]) | (F.get(begins, i + 1)["h"] == x["h"]),
    )
    places = F.sort_array(F.transform(again, lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        places,
        start,
        lambda a, p: F.struct(
            (a["n"] + p + _WINDOW - F.greatest(a["end"], p)).alias("n"), (p + _WINDOW).alias("end")
        ),
    )
    return covered["n"]


def _paired(runs: Column, step: int) -> Column:
    """Hash of each run with the one ``step`` places on; none for the last ``step`` runs."""
    n = F.greatest(F.size(runs) - step, F.lit(0))
    return F.zip_with(F.slice(runs, 1, n), F.slice(runs, 1 + step, n), lambda a, b: F.xxhash64(a, b))


def _barrier(df: DataFrame, *kept: str | Column, **made: Column) -> DataFrame:
    """Compute columns here once: a projection alone would be merged into every later use."""
    row = F.struct(*kept, *[c.alias(n) for n, c in made.items()])
    return df.select(F.explode(F.array(row)).alias("r")).select("r.*")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of whole texts.

    Words are runs of other than space and tab to carriage return; ``word_chars`` their code points; symbols
    are ``#*$%&|<>``; a duplicate line has a word and equals an earlier line; a repeated word lies in a
    window of eight words that stands twice or more in the text (windows may overlap). A null text counts as empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(" \t\n\v\f\r"))
    words = F.when(trimmed != "", F.split(trimmed, f"[{_SPACE}]+")).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{_SPACE}]"))
    split = _barrier(
        docs, F.col(id_col).alias("doc_id"), text.alias("text"), words=words, lines=lines
    )
    counted = _barrier(
        split,
        "doc_id",
        "text",
        n_words=F.size("words").cast("long"),
        word_chars=F.length(F.array_join("words", "")).cast("long"),
        n_symbols=F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        runs=_paired(F.col("words"), 1),
    )
    # Hashes of 2, 4 and then 8 words: each step pairs the runs that meet. A repeated window of 8
    # repeats 5 runs of 4, which few texts do; the others are done here.
    kept = ["doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    fours = _barrier(counted, *kept, runs=_paired(F.col("runs"), 2))
    repeats = F.size("runs") - F.size(F.array_distinct("runs")) >= 5
    windowed = _barrier(fours, *kept, windows=F.when(repeats, _paired(F.col("runs"), 4)))
    # Only texts that repeat a window are sorted.
    begins = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    sorted_ = _barrier(windowed, *kept, begins=begins)
    repeated = F.when(F.col("begins").isNotNull(), _repeated_words(F.col("begins"), F.col("begins")))
    return sorted_.select(
        *kept,
        F.coalesce(repeated, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def rule_costs(
    docs: DataFrame, text_col: str = "text", rules: Mapping[str, str] = RULES, rows: int = SAMPLE_ROWS
) -> list[dict]:
    """Seconds and rejections of each rule on the first ``rows`` rows, best first.

    The sample is bounded by ``rows`` and decides the order of the rules alone. It is taken from the first
    partitions, so the table is not read for it.
    """
    taken = docs.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text")).take(rows)
    sample = measures(docs.sparkSession.createDataFrame(taken, "doc_id int, text string")).cache()
    sample.count()
    found = []
    for name, rule in rules.items():
        begin = time.perf_counter()
        n, rejected = sample.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.expr(f"({rule})").cast("int")), F.lit(0))
        ).first()
        seconds = time.perf_counter() - begin
        found.append({"rule": name, "seconds": seconds, "rows": n, "rejected": rejected})
    sample.unpersist()
    return sorted(found, key=lambda r: (-r["rejected"] / max(r["seconds"], 1e-6), r["seconds"]))


def cascade(rules: Mapping[str, str], order: list[str]) -> Column:
    """The first rule that rejects a row, null if it passes all; a rule runs if those before it pass."""
    chain = None
    for name in order:
        hit = F.coalesce(F.expr(f"({rules[name]})"), F.lit(False))
        chain = F.when(hit, F.lit(name)) if chain is None else chain.when(hit, F.lit(name))
    return chain


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: Mapping[str, str] = RULES,
    sample_rows: int = SAMPLE_ROWS,
    order: list[str] | None = None,
) -> DataFrame:
    """Per row of ``docs``: its measures, base_failed, kept and text.

    ``base_failed``: fewer than 20 words, or over 30% of them repeated. ``kept`` is false if so, else it is
    true if no rule rejects the text. Null and empty texts have no words and fail. Repeated rows are judged
    each; other columns are not read; an empty table gives no rows. ``order`` skips the estimate.
    """
    measured = measures(docs, id_col, text_col)
    if order is None:
        order = [r["rule"] for r in rule_costs(docs, text_col, rules, sample_rows)]
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )
    judged = measured.withColumn("base_failed", failed)
    kept = F.when(F.col("base_failed"), False).otherwise(cascade(rules, order).isNull())
    return judged.withColumn("kept", kept)
