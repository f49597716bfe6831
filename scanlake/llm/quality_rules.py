"""Quality rules learned as a decision list, all in DataFrame operations.

``features`` is a projection over whole texts: counts come from array functions within the row, so nothing is
shuffled and a text of any length stays one row. Words met in repeated 3-word windows are found by sorting a
row's windows with their places and comparing neighbours.

``learn`` is sequential covering. A rule is a conjunction of thresholds on the features that marks bad text.
It grows by the threshold with the best gain on two thirds of the labelled rows and is pruned back on the
other third; rows it covers are set aside, and the next rule is learned from the rest. Every step is one
aggregate over all labelled rows into at most ``features x bins`` counts, which is all the driver sees. The
list becomes one ordered conditional expression.

Null text has no words and fails the base rule. Labels without a document, null labels and repeated labels
of a row are handled by taking the smallest non-null label of a doc_id. No labels: the list is empty and only
the base rule decides. Repeated rows give repeated results. Other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.llm.common import SPACE_RUN, id_and_text
from scanlake.session import written

FEWEST_WORDS = 50
BINS = 24
MOST_RULES = 8
MOST_CONDITIONS = 4
#: A rule must be right on this share of the rows that prune it, and cover this many of those that grow it.
LEAST_PRECISION = 0.7
LEAST_COVER = 5
#: Ratios in thousandths, so that thresholds are whole numbers.
FEATURES = {
    "f_words": "n_words",
    "f_word_length": "div(1000L * word_chars, greatest(n_words, 1))",
    "f_symbols": "div(1000L * n_symbols, greatest(word_chars, 1))",
    "f_dup_lines": "div(1000L * n_dup_lines, greatest(n_lines, 1))",
    "f_repeat": "div(1000L * n_repeat_words, greatest(n_words, 1))",
    "f_upper": "div(1000L * n_upper, greatest(word_chars, 1))",
    "f_exclaim": "div(1000L * n_exclaim, greatest(word_chars, 1))",
    "f_digits": "div(1000L * n_digits, greatest(word_chars, 1))",
    "f_distinct": "div(1000L * n_distinct, greatest(n_words, 1))",
}
_EXACT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: A condition: feature, "<=" or ">", threshold.
Condition = tuple[str, str, int]


def features(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts and further counts for the learned rules; one projection."""
    rows = id_and_text(docs).select(
        "doc_id",
        F.filter(F.split("text", SPACE_RUN), lambda word: word != "").alias("w"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_replace("text", r"[^A-Z0-9!#*$%&|<>]+", "").alias("marks"),
    )
    # Windows of three words with their places, in an order that puts equal windows side by side.
    rows = rows.withColumn(
        "windows",
        F.expr(
            """sort_array(if(size(w) < 3, cast(array() as array<struct<h:bigint,a:string,b:string,c:string,i:int>>),
            transform(sequence(0, greatest(size(w), 3) - 3), i -> struct(
              xxhash64(get(w, i), get(w, i + 1), get(w, i + 2)) as h,
              get(w, i) as a, get(w, i + 1) as b, get(w, i + 2) as c, i))))"""
        ),
    )
    same = "x.h = get(windows, k + {0}).h and x.a = get(windows, k + {0}).a and x.b = get(windows, k + {0}).b and x.c = get(windows, k + {0}).c"
    rows = rows.withColumn(
        "places",
        F.expr(
            f"""sort_array(filter(transform(windows, (x, k) ->
            if(coalesce({same.format(-1)}, false) or coalesce({same.format(1)}, false), x.i, null)),
            i -> i is not null))"""
        ),
    )
    # Words covered by windows at ascending places, three each less what the window before has covered.
    covered = F.expr(
        """aggregate(places, named_struct('last', -3, 'n', 0L),
        (s, i) -> named_struct('last', i, 'n', s.n + least(3, i - s.last)), s -> s.n)"""
    )

    def marks(characters: str) -> Column:
        return F.length(F.regexp_replace("marks", f"[^{characters}]+", "")).cast("long")

    return rows.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        marks("#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        marks("A-Z").alias("n_upper"),
        marks("!").alias("n_exclaim"),
        marks("0-9").alias("n_digits"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _test(condition: Condition) -> Column:
    name, side, value = condition
    return F.col(name) <= value if side == "<=" else F.col(name) > value


def _rule(conditions: list[Condition]) -> Column:
    return reduce(and_, map(_test, conditions))


def _any(rules: list[list[Condition]]) -> Column:
    return reduce(or_, map(_rule, rules), F.lit(False))


def _gain(bad: float, good: float, bad_before: float, good_before: float) -> float:
    """Information gained on the bad rows still covered."""
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad_before / (bad_before + good_before)))


def _grown(rows: DataFrame, thresholds: dict[str, list[int]]) -> list[Condition]:
    """Add the threshold of most gain until no good row is covered or nothing is gained."""
    rule: list[Condition] = []
    while len(rule) < MOST_CONDITIONS:
        left = rows.where(_rule(rule)) if rule else rows
        # For each feature, rows by the number of thresholds below their value: two counts a bin.
        bins = [
            F.struct(
                F.lit(name).alias("name"),
                sum([(F.col(name) > t).cast("int") for t in cuts], F.lit(0)).alias("bin"),
            )
            for name, cuts in thresholds.items()
        ]
        counts = (
            left.select("bad", F.explode(F.array(*bins)).alias("b"))
            .groupBy("b.name", "b.bin")
            .agg(F.sum("bad").alias("bad"), F.count("*").alias("n"))
            .collect()
        )
        table = {(r["name"], r["bin"]): (r["bad"], r["n"] - r["bad"]) for r in counts}
        first = next(iter(thresholds))
        bad, good = (sum(v[k] for (name, _), v in table.items() if name == first) for k in (0, 1))
        if not bad or not good:
            break
        best: tuple[float, Condition | None] = (0.0, None)
        for name in sorted(thresholds):
            below = [0, 0]
            for n, cut in enumerate(thresholds[name]):
                step = table.get((name, n), (0, 0))
                below = [below[0] + step[0], below[1] + step[1]]
                for side, b, g in (("<=", *below), (">", bad - below[0], good - below[1])):
                    gain = _gain(b, g, bad, good)
                    if b + g >= LEAST_COVER and gain > best[0] + 1e-9:
                        best = (gain, (name, side, cut))
        if best[1] is None:
            break
        rule.append(best[1])
    return rule


def learn(rows: DataFrame, labels: DataFrame) -> list[list[Condition]]:
    """Ordered rules for bad text, from the features of rows and ``labels`` (doc_id, quality 0 or 1)."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    train = written(
        rows.where(~base_failed())
        .select("doc_id", *[F.expr(e).cast("long").alias(n) for n, e in FEATURES.items()])
        .join(known.withColumnRenamed("doc_id", "labelled"), F.col("doc_id") == F.col("labelled"))
        .select(
            *FEATURES, (F.col("quality") == 0).cast("long").alias("bad"),
            (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prunes"),
        ),
        "labelled-features",
    )
    at = [(k + 1) / BINS for k in range(BINS - 1)]
    # Finer towards both ends, where junk lies.
    at = sorted({0.005, 0.01, 0.02, 0.03, *at, 0.97, 0.98, 0.99, 0.995})
    found = train.agg(*[F.percentile_approx(n, at, 10000).alias(n) for n in FEATURES]).first()
    thresholds = {n: sorted(set(found[n] or [])) for n in FEATURES}
    if not any(thresholds.values()):
        return []
    rules: list[list[Condition]] = []
    while len(rules) < MOST_RULES:
        left = train.where(~_any(rules))
        rule = _grown(left.where("not prunes"), thresholds)
        if not rule:
            break
        prefixes = [rule[: k + 1] for k in range(len(rule))]
        judged = left.where("prunes").agg(
            *[F.sum(F.when(_rule(p), F.col("bad"))).alias(f"b{k}") for k, p in enumerate(prefixes)],
            *[F.sum(F.when(_rule(p), 1 - F.col("bad"))).alias(f"g{k}") for k, p in enumerate(prefixes)],
        ).first()
        scores = [
            (((judged[f"b{k}"] or 0) - (judged[f"g{k}"] or 0)) / max(1, (judged[f"b{k}"] or 0) + (judged[f"g{k}"] or 0)), -k)
            for k in range(len(prefixes))
        ]
        score, k = max(scores)
        if (score + 1) / 2 < LEAST_PRECISION:
            break
        rules.append(prefixes[-k])
    return rules


def decision(rules: list[list[Condition]]) -> Column:
    """The number of the first rule that holds, null if none does: an ordered conditional expression."""
    out = F.lit(None).cast("int")
    for n, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(_rule(rule), F.lit(n)).otherwise(out)
    return out


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The base counts, base_failed, the rule that rejects the text if any, and kept.

    Features are computed once, into the shared folder; rules are learned from them and applied to them.
    """
    rows = written(features(docs), "text-features")
    rules = learn(rows, labels)
    rows = rows.select("*", *[F.expr(e).cast("long").alias(n) for n, e in FEATURES.items()])
    rows = rows.select(*_EXACT, base_failed().alias("base_failed"), decision(rules).alias("rule"))
    return rows.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).withColumn(
        "rule", F.coalesce("rule", F.lit(0))
    )
