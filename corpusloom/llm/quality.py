"""Quality by weak supervision: rules vote or abstain, and a label model weighs them.

Each rule looks at one fact of a text and votes that the text is bad, votes that
it is good, or abstains. No rule decides alone: expectation-maximisation over
all documents estimates how often each rule is right on good texts and on bad
ones, and a text stays if its posterior probability of being good is at least
one half and the two hard limits do not fail it. Abstaining says nothing about a
text.

The votes of a document are a word over three letters. The documents are counted
per word, so the estimation sees at most 3^rules rows whatever the corpus; that
is the proven bound of what one task gathers and what is sent to all tasks.
Counting covers all documents and is combined map-side. Everything is built-in
functions; a text's five-word windows are compared inside its own row, first by
hash, and only where two hashes are equal by the words themselves.

Defined results: a null text has no words and fails the limits; equal or null keys are rows
of their own; very long texts are taken whole; an empty table gives no rows;
other columns are ignored and may have any names. Sums go over the patterns in
their order, so equal documents give equal estimates.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import Workspace

# What counts as a symbol, and as white space.
_SYMBOLS = r"[#*$%&|<>]+"
_GAP = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"
WINDOW = 5

BAD, GOOD, ABSTAIN = "b", "g", "-"


@dataclass(frozen=True)
class Rule:
    """`bad` and `good` are SQL conditions on the facts; where neither holds the rule abstains."""

    name: str
    bad: str
    good: str
    when: str = "true"


#: Shares are compared by multiplication, so that no text divides by zero.
RULES = (
    Rule("symbols", "10 * n_symbols >= n_words", "100 * n_symbols < n_words", "n_words > 0"),
    Rule("letter_words", "10 * n_letter_words < 8 * n_words", "100 * n_letter_words >= 95 * n_words", "n_words >= 20"),
    Rule("letters", "10 * n_letters < 7 * word_chars", "10 * n_letters >= 9 * word_chars", "n_words >= 20"),
    Rule("capitals", "2 * n_capitals > n_letters", "100 * n_capitals < 15 * n_letters", "n_letters > 0"),
    Rule("repeats", "5 * n_repeat_words > n_words", "20 * n_repeat_words < n_words", "n_words > 0"),
    Rule("variety", "10 * n_distinct_words < 3 * n_words", "2 * n_distinct_words >= n_words", "n_words >= 10"),
    Rule("echoes", "10 * n_echoes > n_words", "100 * n_echoes < 3 * n_words", "n_words >= 10"),
    Rule("lines", "2 * n_dup_lines > n_word_lines", "n_dup_lines = 0", "n_word_lines >= 3"),
    Rule("word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words",
         "word_chars >= 4 * n_words AND 2 * word_chars <= 13 * n_words", "n_words > 0"),
    Rule("sentences", "2 * n_ended_lines < n_word_lines", "10 * n_ended_lines >= 9 * n_word_lines", "n_words >= 20"),
)


@dataclass(frozen=True)
class Prior:
    """What is believed before counting, worth `weight` documents: a rule is right
    on good texts nearly always, and finds some of the bad ones."""

    good: float = 0.8
    right_on_good: float = 0.99
    right_on_bad: float = 0.3
    weight: float = 1.0


#: Estimates keep this distance from 0 and 1.
EDGE = 1e-6
ITERATIONS = 20


def _characters(text: str, others: str) -> Column:
    """The number of code points left when those matching `others` go."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def _count(array: Column) -> Column:
    return F.size(array).cast("long")


def facts(documents: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(key, facts...) per document; `key` is a struct of the key columns."""
    rows = documents.select(
        F.struct(*[F.col(k) for k in keys]).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    # One projection per step: a column that the next step names often is made once.
    split = rows.select(
        "key",
        F.filter(F.split("text", _GAP), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(_WORD)).alias("lines"),
        (F.length("text") - _characters("text", _SYMBOLS)).cast("long").alias("n_symbols"),
        _characters("text", r"[^\p{Lu}]+").alias("n_capitals"),
    )
    words = F.col("words")
    ended = r"[.!?][\x20\x09-\x0D]*\z"
    counted = split.select(
        "key",
        "words",
        _count(words).alias("n_words"),
        "n_symbols",
        "n_capitals",
        F.array_join("words", "").alias("joined"),
        _count(F.col("lines")).alias("n_word_lines"),
        (_count(F.col("lines")) - _count(F.array_distinct("lines"))).alias("n_dup_lines"),
        _count(F.filter("lines", lambda line: line.rlike(ended))).alias("n_ended_lines"),
        _count(F.array_distinct("words")).alias("n_distinct_words"),
        _count(F.filter("words", lambda w: w.rlike(r"\p{L}"))).alias("n_letter_words"),
        _count(F.filter("words", lambda w, i: (i > 0) & (w == F.get(words, i - 1)))).alias("n_echoes"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    hashes, windows = F.col("hashes"), F.col("windows")
    after = lambda i: [F.get(hashes, i + j) for j in range(1, WINDOW)]
    hashed = counted.withColumns(
        {
            "word_chars": F.length("joined").cast("long"),
            "n_letters": _characters("joined", r"[^\p{L}]+"),
            "starting": F.slice(F.transform("hashes", lambda h, i: F.xxhash64(h, *after(i))), 1, _windows()),
        }
    ).drop("joined", "hashes")
    # Equal windows have equal hashes; only texts with equal hashes compare the words.
    may = F.size(F.array_distinct("starting")) < F.size("starting")
    window = lambda i: F.struct(F.slice(words, i + 1, WINDOW).alias("w"), i.alias("i"))
    ordered = hashed.withColumn(
        "windows", F.when(may, F.sort_array(F.transform(F.sequence(F.lit(0), _windows() - 1), window)))
    ).drop("starting", "words")
    same = lambda x, j: F.coalesce(F.get(windows, j)["w"] == x["w"], F.lit(False))
    twice = F.filter("windows", lambda x, j: same(x, j - 1) | same(x, j + 1))
    starts = ordered.withColumn("starts", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("windows")
    # A start covers its window, as far as the next start does not.
    covers = F.transform(
        "starts", lambda p, j: F.coalesce(F.least(F.lit(WINDOW), F.get(F.col("starts"), j + 1) - p), F.lit(WINDOW))
    )
    n_repeat = F.aggregate(covers, F.lit(0).cast("long"), lambda total, n: total + n)
    return starts.withColumn("n_repeat_words", F.coalesce(n_repeat, F.lit(0).cast("long"))).drop("starts")


def _windows() -> Column:
    return F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))


def votes(rules=RULES) -> Column:
    """One letter per rule."""
    letters = [
        F.when(F.expr(f"({r.when}) AND ({r.bad})"), BAD).when(F.expr(f"({r.when}) AND ({r.good})"), GOOD).otherwise(ABSTAIN)
        for r in rules
    ]
    return F.concat(*letters)


def _over(places: range, step: Callable[[Column, int], Column]) -> Column:
    """A product over the rules, first to last."""
    product = F.lit(1.0)
    for j in places:
        product = product * step(j)
    return product


def posteriors(counts: DataFrame, rules: int, prior: Prior = Prior(), iterations: int = ITERATIONS) -> DataFrame:
    """(pattern, quality) for counts(pattern, documents): at most 3^rules rows.

    All patterns meet in one row, where the rounds of expectation and maximisation
    run as nested array functions.
    """
    every = range(rules)
    listed = counts.agg(
        F.array_sort(
            F.collect_list(
                F.struct("pattern", F.split("pattern", "").alias("votes"), F.col("documents").cast("double").alias("n"))
            )
        ).alias("patterns")
    )
    inside = lambda x: F.least(F.greatest(x, F.lit(EDGE)), F.lit(1 - EDGE))

    def good_share(p: Column, state: Column) -> Column:
        def chance(right: Column, vote: str, other: str) -> Callable[[int], Column]:
            return lambda j: (
                F.when(p["votes"][j] == vote, right[j]).when(p["votes"][j] == other, 1 - right[j]).otherwise(F.lit(1.0))
            )

        good = state["good"] * _over(every, chance(state["on_good"], GOOD, BAD))
        bad = (1 - state["good"]) * _over(every, chance(state["on_bad"], BAD, GOOD))
        return good / (good + bad)

    def step(state: Column, _: Column) -> Column:
        weighed = F.transform(
            "patterns",
            lambda p: F.struct(
                p["votes"].alias("votes"), p["n"].alias("n"), (p["n"] * good_share(p, state)).alias("g")
            ),
        )
        # The weighed patterns are held once per round, as the only element of an array.
        return F.transform(F.array(weighed), lambda w: estimate(w))[0]

    def total(w: Column, value: Callable[[Column], Column]) -> Column:
        return F.aggregate(w, F.lit(0.0), lambda acc, p: acc + value(p))

    def estimate(w: Column) -> Column:
        def rate(j: int, believed: float, vote: str, mass: Callable[[Column], Column]) -> Column:
            hit = total(w, lambda p: F.when(p["votes"][j] == vote, mass(p)).otherwise(F.lit(0.0)))
            voted = total(w, lambda p: F.when(p["votes"][j] != ABSTAIN, mass(p)).otherwise(F.lit(0.0)))
            return inside((F.lit(prior.weight * believed) + hit) / (F.lit(prior.weight) + voted))

        good = lambda p: p["g"]
        bad = lambda p: p["n"] - p["g"]
        share = (F.lit(prior.weight * prior.good) + total(w, good)) / (F.lit(prior.weight) + total(w, lambda p: p["n"]))
        return F.struct(
            inside(share).alias("good"),
            F.array(*[rate(j, prior.right_on_good, GOOD, good) for j in every]).alias("on_good"),
            F.array(*[rate(j, prior.right_on_bad, BAD, bad) for j in every]).alias("on_bad"),
        )

    start = F.struct(
        F.lit(prior.good).alias("good"),
        F.array(*[F.lit(prior.right_on_good) for _ in every]).alias("on_good"),
        F.array(*[F.lit(prior.right_on_bad) for _ in every]).alias("on_bad"),
    )
    state = F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start, step)
    fitted = listed.withColumn("state", state)
    each = fitted.select("state", F.explode("patterns").alias("p"))
    return each.select("p.pattern", good_share(F.col("p"), F.col("state")).alias("quality"))


def assess(documents: DataFrame, keys: list[str], text: str, rules=RULES, prior: Prior = Prior()) -> DataFrame:
    """Facts, `votes`, `quality` (the posterior), `base_failed` and `kept` per document."""
    work = Workspace(documents.sparkSession)
    voted = work.save(facts(documents, keys, text).withColumn("votes", votes(rules)), "votes")
    counts = voted.groupBy(F.col("votes").alias("pattern")).agg(F.count("*").alias("documents"))
    found = work.save(posteriors(counts, len(rules), prior), "posteriors").withColumnRenamed("pattern", "votes")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    # At most 3^rules rows.
    return (
        voted.join(F.broadcast(found), "votes")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("quality") >= 0.5))
    )
