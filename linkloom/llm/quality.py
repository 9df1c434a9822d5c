"""Quality rules as a table of thresholds, compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import named

_SPACE = r"[\x20\x09-\x0D]"
_SPACES = " \t\n\x0b\x0c\r"

#: Frequent function words of the languages at hand; other languages pass their own.
STOP_WORDS = (
    "the be to of and that have with is are was for it in on as at by from this or an "
    "le la les de des du un une et est en que qui dans pour pas sur par avec au aux "
    "der die das und ist nicht ein eine mit von zu den dem sich auf für als auch im "
    "el los las una y es por con para no se su lo al del como más"
).split()


@dataclass(frozen=True)
class Rule:
    """A measure must lie between the bounds; None leaves a side open."""

    measure: str
    least: float | None = None
    most: float | None = None


#: Bounds on measures of one text. Ratios are per word or per line.
RULES = (
    Rule("mean_word_chars", 2, 12),
    Rule("symbols_per_word", most=0.2),
    Rule("marks_per_word", most=1.0),
    Rule("capital_word_ratio", most=0.5),
    Rule("dup_line_ratio", most=0.5),
    Rule("repeat_word_ratio", most=0.5),
    Rule("stop_word_ratio", least=0.02),
)


def measures(text: Column, stop_words: list[str] | tuple[str, ...] = tuple(STOP_WORDS)) -> dict[str, list[tuple[str, Column]]]:
    """Named steps: each step's columns use only those of earlier ones."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words, lines, hashes = F.col("_words"), F.col("_lines"), F.col("_windows")
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    no_words = F.array().cast("array<string>")
    trimmed = F.btrim(text, F.lit(_SPACES))
    # a window's hash and place; equal windows are neighbours once sorted
    windows = F.when(F.size(words) >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("hash"), i.alias("at")))))
    repeated = F.filter(hashes, lambda w, k: (w["hash"] == F.get(hashes, k - 1)["hash"]) | (w["hash"] == F.get(hashes, k + 1)["hash"]))
    starts = F.array_sort(F.transform(repeated, lambda w: w["at"]))
    covered = F.aggregate(
        F.col("_starts"), F.struct(F.lit(0).alias("total"), F.lit(-3).alias("last")),
        lambda a, at: F.struct((a["total"] + F.least(F.lit(3), at - a["last"])).alias("total"), at.alias("last")), lambda a: a["total"])
    return {
        "words": [
            ("_text", text),
            ("_words", F.when(trimmed == "", no_words).otherwise(F.split(trimmed, _SPACE + "+"))),
            ("_lines", F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))),
        ],
        "windows": [
            ("n_words", F.size(words).cast("long")),
            ("word_chars", F.length(F.array_join(words, "")).cast("long")),
            ("n_symbols", F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long")),
            ("n_marks", F.regexp_count("_text", F.lit(r"[!?]")).cast("long")),
            ("n_lines", F.size(lines).cast("long")),
            ("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")),
            ("n_stop_words", F.size(F.filter(words, lambda w: F.lower(w).isin(list(stop_words)))).cast("long")),
            ("n_capital_words", F.size(F.filter(words, lambda w: w.rlike(r"\p{Lu}{2}") & (w == F.upper(w)))).cast("long")),
            ("_windows", windows),
        ],
        "starts": [("_starts", F.coalesce(starts, F.array().cast("array<int>")))],
        "repeats": [("n_repeat_words", covered.cast("long"))],
        "ratios": [
            ("mean_word_chars", F.col("word_chars") / n),
            ("symbols_per_word", F.col("n_symbols") / n),
            ("marks_per_word", F.col("n_marks") / n),
            ("capital_word_ratio", F.col("n_capital_words") / n),
            ("stop_word_ratio", F.col("n_stop_words") / n),
            ("repeat_word_ratio", F.col("n_repeat_words") / n),
            ("dup_line_ratio", F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double")),
        ],
    }


def compiled(rules: tuple[Rule, ...] | list[Rule]) -> Column:
    """The table as one condition: true if every measure lies within its bounds."""
    verdict = F.lit(True)
    for rule in rules:
        if rule.least is not None:
            verdict = verdict & (F.col(rule.measure) >= F.lit(float(rule.least)))
        if rule.most is not None:
            verdict = verdict & (F.col(rule.measure) <= F.lit(float(rule.most)))
    return verdict


def judge(df: DataFrame, text_column: str = "text", carry: dict[str, Column] | None = None, rules: tuple[Rule, ...] | list[Rule] = RULES,
          stop_words: list[str] | tuple[str, ...] = tuple(STOP_WORDS)) -> DataFrame:
    """Counts, ratios, ``base_failed`` and ``kept`` of every row, with what ``carry`` names. No shuffle, no user function.

    The base fails a text of fewer than 50 words, or with over half of its words in repeated windows of
    three; what it fails is not kept whatever the rules say. Null is a text without words, and fails. Two
    windows count as equal if their 64-bit hashes are.
    A repeated row has its own verdict, an empty table gives an empty one, and no column but the text and those of
    ``carry`` is read, whatever its name.
    """
    carry = carry or {}
    now = df.select(F.struct(F.lit(0).alias("_"), *[v.alias(k) for k, v in carry.items()]).alias("_carried"), named(text_column).alias("_given"))
    for columns in measures(F.col("_given"), stop_words).values():
        now = now.select("*", *[value.alias(name) for name, value in columns])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    kept = [name for columns in measures(F.col("_given")).values() for name, _ in columns if not name.startswith("_")]
    now = now.select("_carried", *kept, failed.alias("base_failed"), (~failed & compiled(rules)).alias("kept"))
    return now.select(*[F.col(f"_carried.{k}").alias(k) for k in carry], *[c for c in now.columns if c != "_carried" and c not in carry])
