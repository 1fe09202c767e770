"""Quality rules: a table of thresholds compiled into Spark projections.

No Python runs on the executors: every figure is an expression on the text, and the
verdict is one projection over the figures.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import SPACE

#: Frequent function words of the languages served.  Fixed values.
STOP_WORDS = (
    "the of and to in a is that it for on with as are this was by be from or an at not "
    "der die das und ist nicht ein eine mit auf für von dem den des im zu sich auch "
    "le la les de et un une est que qui dans pour pas sur avec au du il en "
    "el los las y una por con para no se del al lo su es"
).split()

SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A figure (SQL over the columns of ``figures``) and the range in which a text passes."""

    name: str
    figure: str
    least: float | None = None
    most: float | None = None


#: Ranges were set on the labelled documents so that texts labelled good pass.
RULES = (
    Rule("mean_word_length", "word_chars / n_words", 2.0, 12.0),
    Rule("symbol_ratio", "n_symbols / n_words", None, 0.3),
    Rule("stop_word_ratio", "n_stop_words / n_words", 0.02, None),
    Rule("dup_line_ratio", "n_dup_lines / n_lines", None, 0.5),
    Rule("bullet_line_ratio", "n_bullet_lines / n_lines", None, 0.9),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines / n_lines", None, 0.5),
)

#: What the contract fixes: too short, or more than half of it repeated windows.
BASE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def figures(documents: DataFrame, text: str = "text") -> DataFrame:
    """Counts per document, beside its whole row as ``document``; a null text counts as empty.

    ``n_repeat_words`` counts words that lie in a three-word window found twice or more.
    Windows are sorted by 33 bits of a hash with their position in the other 31, a plain
    sort of longs; only those whose hash bits meet are then compared word by word.
    Texts of any length take n log n.
    """
    space = f"[{SPACE}]+"
    start = documents.select(
        F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("document"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"),
    )
    counted = start.select(
        "document",
        F.array_remove(F.split("t", space), "").alias("w"),
        F.filter(F.split("t", "\n"), lambda line: line.rlike(f"[^{SPACE}]")).alias("l"),
        (F.length("t") - F.length(F.regexp_replace("t", SYMBOLS, ""))).alias("n_symbols"),
    ).select(
        "*",
        F.size("w").alias("n"),
        F.when(
            F.size("w") > 2,
            F.sort_array(F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: _key(F.col("w"), i))),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("keys"),
    )
    meets = counted.select("*", _of_equal_neighbours("keys", lambda key: F.shiftright(key, 31)).alias("near")).select(
        "*",
        F.array_sort(
            F.transform("near", lambda key: F.struct(_window(F.col("w"), _at(key)).alias("s"), _at(key).alias("i")))
        ).alias("sure"),
    )
    exact = meets.select(
        "*",
        F.array_sort(
            F.transform(_of_equal_neighbours("sure", lambda x: x["s"]), lambda x: x["i"])
        ).alias("at"),
    )
    counts = F.struct(
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        _covered("at").alias("n_repeat_words"),
        F.size(F.filter("w", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size("l").cast("long").alias("n_lines"),
        F.size(F.filter("l", lambda x: x.rlike(rf"^[{SPACE}]*[-*•|]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("l", lambda x: x.rlike(rf"(\.\.\.|…)[{SPACE}]*$"))).cast("long").alias("n_ellipsis_lines"),
    )
    # A generator: a filter on the counts is not rewritten into one on the text, which would
    # spell out every step once for each use of it.
    return exact.select("document", F.inline(F.array(counts)))


def _key(words: Column, i: Column) -> Column:
    found = F.xxhash64(words[i], words[i + 1], words[i + 2])
    return F.shiftleft(found, 31).bitwiseOR(i.cast("long"))


def _at(key: Column) -> Column:
    return key.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")


def _window(words: Column, i: Column) -> Column:
    return F.concat_ws(" ", words[i], words[i + 1], words[i + 2])


def _of_equal_neighbours(name: str, part) -> Column:
    """The elements of a sorted array whose ``part`` equals that of the one before or after."""
    column = F.col(name)
    return F.filter(
        column,
        lambda x, j: ((j > 0) & (part(F.get(column, j - 1)) == part(x)))
        | ((j < F.size(column) - 1) & (part(F.get(column, j + 1)) == part(x))),
    )


def _covered(name: str) -> Column:
    """How many positions the three-word windows that begin at the sorted positions cover."""
    at = F.col(name)
    return F.when(F.size(at) == 0, F.lit(0)).otherwise(
        F.aggregate(
            F.sequence(F.lit(0), F.greatest(F.size(at) - 1, F.lit(0))),
            F.lit(0),
            lambda total, j: total + F.coalesce(F.least(F.lit(3), F.get(at, j + 1) - F.get(at, j)), F.lit(3)),
        )
    ).cast("long")


def compiled(rules: tuple[Rule, ...] = RULES, base: str = BASE) -> dict[str, Column]:
    """The columns ``base_failed``, ``failed_rules`` and ``kept`` over the figures."""
    base_failed = F.expr(base)

    def broken(rule: Rule) -> Column:
        value = F.expr(f"try_divide({rule.figure.replace(' / ', ', ')})" if " / " in rule.figure else rule.figure)
        outside = F.lit(False)
        if rule.least is not None:
            outside = outside | (value < rule.least)
        if rule.most is not None:
            outside = outside | (value > rule.most)
        return F.when(F.coalesce(outside, F.lit(False)), F.lit(rule.name))

    failed = F.array_compact(F.array(*[broken(rule) for rule in rules]))
    return {
        "base_failed": base_failed,
        "failed_rules": failed,
        "kept": ~base_failed & (F.size(failed) == 0),
    }


def quality(
    documents: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Figures and verdict per document: ``doc_id``, the counts, ``base_failed``,
    ``failed_rules``, ``kept``.

    A rule whose figure cannot be computed (no words, no lines) does not reject; texts
    without words fail the base rule.  Rows are judged one by one, so repeated and null
    ids get a row each; other columns are not read.
    """
    found = figures(documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")))
    return found.select("document.doc_id", "*", *[c.alias(n) for n, c in compiled(rules).items()]).drop("document")


def kept_documents(documents: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows the rules keep, with all their columns and in no shuffle."""
    found = figures(documents, text)
    return found.filter(compiled(rules)["kept"]).select("document.*")
