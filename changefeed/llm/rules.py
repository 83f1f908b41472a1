r"""Quality rules as a short-circuit cascade, in DataFrame expressions alone.

Each rule is a condition that rejects a document and a cost, the characters it
looks at. Both are measured on a bounded sample (``SAMPLE_ROWS`` different rows, those
with the smallest hashes of the whole table), and the next rule is the one with the
most rejections per cost among the rows that the rules before it let pass: a document
that one rule rejects is not looked at by the later ones, because CASE stops at its
first true branch. The verdict is that of all rules together, so a poor estimate
costs time but changes no result. The order depends on the rows alone, not on timing.

The base measures are part of the report and computed for every document.
Documents that fail on them are rejected before the cascade begins.

Cases: a null text has no words and no lines, fails the base and is rejected;
repeated rows are judged each for itself; the id may be null or repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 500

# Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the be to of and that have with is in a der die das und ist von zu mit den nicht "
    "le la les de des et un une en que el los las y por con para est il du se"
).split()


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a SQL condition over ``words``, ``lines`` and the base measures, ``cost`` a number over the same."""

    name: str
    rejects: str
    cost: str = "word_chars"


_STOPS = ", ".join(f"'{w}', '{w.capitalize()}'" for w in STOP_WORDS)

RULES = (
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 12 * n_words", "1"),
    Rule("symbols", "10 * n_symbols > n_words", "1"),
    Rule("dup_lines", "10 * n_dup_lines > 3 * size(lines)", "1"),
    Rule("ellipsis", r"10 * size(filter(lines, l -> l rlike '(\\.\\.\\.|…)\\s*$')) > 3 * size(lines)"),
    Rule("bullets", r"10 * size(filter(lines, l -> l rlike '^\\s*[-*•]')) > 9 * size(lines)", "4 * size(lines)"),
    Rule("letters", r"10 * length(regexp_replace(array_join(words, ''), '\\p{L}+', '')) > 4 * word_chars", "2 * word_chars"),
    Rule("stop_words", f"size(array_intersect(words, array({_STOPS}))) < 2"),
)

# Words are what remains between ASCII blanks; five of those characters become spaces first.
_SPACED = r"translate(text, '\t\n\u000b\u000c\r', '     ')"
_WORDS = f"case when trim({_SPACED}) <> '' then split(trim({_SPACED}), ' +') else cast(array() as array<string>) end"
_LINES = r"case when text is null then cast(array() as array<string>) else split(text, '\n', -1) end"
_BODY = "coalesce(text, '')"
_WORDY = r"filter(lines, x -> x rlike '[^\\x20\\x09-\\x0D]')"

# Repeated windows. Hashes of all windows are told apart by a set first; where some are
# equal, the upper hash bits and the position are packed in one number and sorted, so
# that equal windows are neighbours. Neighbours are then compared word by word; should
# one pair differ, the text is done over with the windows themselves.
_HASHES = (
    "case when n_words < 4 then cast(array() as array<bigint>) else "
    "transform(slice(words, 1, size(words) - 2), (w, i) -> xxhash64(w, words[i + 1], words[i + 2])) end"
)
_PLACE = "cast(s[{k}] & (shiftleft(1L, bits) - 1) as int)"
_SAME = " and ".join(f"words[{_PLACE.format(k='k')} + {d}] = words[{_PLACE.format(k='k - 1')} + {d}]" for d in range(3))
_WINDOWS = (
    "sort_array(transform(slice(words, 1, size(words) - 2), "
    "(w, i) -> named_struct('a', w, 'b', words[i + 1], 'c', words[i + 2], 'i', i)))"
)


def _add(df: DataFrame, name: str, value: str) -> DataFrame:
    """Add a column that later expressions use by name and never compute again."""
    return df.withColumn(name, F.explode(F.expr(f"array({value})")))


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, words, lines, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    df = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    df = df.select("key", F.explode(F.expr(
        f"array(named_struct('words', {_WORDS}, 'lines', {_LINES}, 'n_symbols', "
        f"cast(length({_BODY}) - length(translate({_BODY}, '#*$%&|<>', '')) as bigint)))"
    )).alias("t")).select("key", "t.*")
    df = df.withColumn("n_words", F.size("words").cast("bigint"))
    df = df.withColumn("word_chars", F.length(F.array_join("words", "")).cast("bigint"))
    df = _add(df, "wordy", _WORDY)
    df = df.withColumn("n_dup_lines", F.expr("cast(size(wordy) - size(array_distinct(wordy)) as bigint)")).drop("wordy")
    df = _add(df, "h", _HASHES).withColumn("bits", F.expr("cast(ceil(log2(size(h) + 1)) as int)"))
    df = _add(
        df, "s",
        "case when size(array_distinct(h)) = size(h) then cast(array() as array<bigint>) "
        "else sort_array(transform(h, (x, i) -> shiftleft(x, bits) | i)) end",
    ).drop("h")
    df = _add(
        df, "pairs",
        "case when size(s) = 0 then cast(array() as array<int>) else "
        "filter(sequence(1, size(s) - 1), k -> shiftrightunsigned(s[k - 1] ^ s[k], bits) = 0) end",
    )
    df = _add(
        df, "starts",
        f"case when size(pairs) = 0 then cast(array() as array<int>) "
        f"when forall(pairs, k -> {_SAME}) then array_sort(array_distinct(flatten(transform(pairs, "
        f"k -> array({_PLACE.format(k='k - 1')}, {_PLACE.format(k='k')}))))) "
        f"else {_exact_starts()} end",
    )
    df = df.withColumn("n_repeat_words", F.expr(
        "aggregate(starts, named_struct('last', -3, 'n', 0L), "
        "(a, p) -> named_struct('last', p, 'n', a.n + least(3, p - a.last)), a -> a.n)"
    ))
    return df.withColumn(
        "base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    ).drop("s", "pairs", "starts", "bits")


def _exact_starts() -> str:
    """Starts of repeated windows from the sorted windows themselves."""
    equal = " and ".join(f"v[k - 1].{c} = v[k].{c}" for c in "abc")
    return (
        f"array_sort(array_distinct(flatten(element_at(transform(array({_WINDOWS}), v -> "
        f"transform(filter(sequence(1, size(v) - 1), k -> {equal}), k -> array(v[k - 1].i, v[k].i))), 1))))"
    )


def sampled(rows: DataFrame) -> DataFrame:
    """``SAMPLE_ROWS`` different rows of (key, text), or all: one number meets on the driver, the texts stay where they are."""
    mark = F.xxhash64("key", "text")
    last = rows.select(mark.alias("h")).distinct().orderBy("h").limit(SAMPLE_ROWS).agg(F.max("h")).first()[0]
    few = rows.filter(mark <= F.lit(last).cast("bigint")).withColumn("h", mark)
    return few.dropDuplicates(["h"]).drop("h")


def in_order(sample: DataFrame, rules: tuple[Rule, ...]) -> list[Rule]:
    """Rules by rejections per cost over the rows of a measured sample that no rule before rejects."""
    hits = F.array(*[F.coalesce(F.expr(rule.rejects), F.lit(False)) for rule in rules])
    costs = [F.sum(F.expr(rule.cost).cast("double")).alias(f"c{i}") for i, rule in enumerate(rules)]
    # at most one row for each row of the sample
    left = sample.groupBy(hits.alias("hits")).agg(F.count("*").alias("n"), *costs).collect()
    whole = [sum(row[f"c{i}"] or 0 for row in left) for i in range(len(rules))]
    waiting, ordered = list(range(len(rules))), []
    while waiting:
        def rate(i):
            rejected = sum(row["n"] for row in left if row["hits"][i])
            return -(rejected + 1) / (1 + sum(row[f"c{i}"] or 0 for row in left)), whole[i], rules[i].name

        best = min(waiting, key=rate)
        waiting.remove(best)
        ordered.append(rules[best])
        left = [row for row in left if not row["hits"][best]]
    return ordered


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base measures, base_failed, kept): ``kept`` is false if the base or any rule rejects."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    ordered = in_order(measured(sampled(rows), "key", "text").filter("not base_failed"), rules)
    branches = " ".join(f"when {rule.rejects} then false" for rule in ordered)
    verdict = f"case when base_failed then false {branches} else true end"
    return measured(docs, key, text).select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", F.expr(verdict).alias("kept"),
    )
