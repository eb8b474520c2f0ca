"""Quality rules by weak supervision, in DataFrame operations only.

Each rule votes good (1) or bad (-1) on a text or abstains (0). Each looks at a
count of its own, so that given a text's quality the votes are about independent.
The model has three rates per rule and quality: how often it votes good, abstains
and votes bad on good texts, and on bad ones. So a rule that only ever raises
alarms can be rated as well (its hits and its false alarms), and so can its
silence. Expectation-maximisation over the counts of distinct vote patterns (at
most 3 ** rules rows, whatever the input) estimates the rates and the share of
good texts; a text is kept when its posterior probability of being good is at
least ``keep_at``. So one doubtful vote no longer rejects a text, as it does when
all rules must pass.

Defined cases: a null or empty text has no words and fails the base rules;
rows that repeat are scored as they stand; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stage, words

SYMBOLS = "#*$%&|<>"
#: Letters with one mark of a sentence at most; words without letter or digit;
#: words that start with a letter and end in two characters that aren't letters.
_START, _END = r"(?<![^\x20\x09-\x0D])", r"(?![^\x20\x09-\x0D])"
PLAIN = rf"{_START}\p{{L}}+[.,;:!?]?{_END}"
LONE = rf"{_START}[^\p{{L}}\p{{N}}\x20\x09-\x0D]+{_END}"
ODD_END = rf"{_START}\p{{L}}[^\x20\x09-\x0D]*[^\p{{L}}\x20\x09-\x0D]{{2}}{_END}"

#: (rule, SQL measure over the features, good vote when, bad vote when); a null
#: measure (too few words to say) abstains.
RULES = (
    ("length", "n_words", "x >= 30", "x < 10"),
    ("repeats", "100.0 * n_repeat_words / nullif(n_words, 0)", "x <= 1", "x > 20"),
    ("symbols", "100.0 * n_symbols / nullif(word_chars, 0)", "x <= 0.2", "x > 3"),
    ("capitals", "100.0 * n_capitals / nullif(word_chars, 0)", "x between 0.2 and 8", "x > 20"),
    ("sentences", "case when n_words >= 20 then 100.0 * n_stops / n_words end", "x between 2 and 25", "x < 1 or x > 50"),
    ("commas", "case when n_words >= 40 then 100.0 * n_commas / n_words end", "x between 1 and 15", "x < 0.5 or x > 40"),
    ("word_length", "1.0 * word_chars / nullif(n_words, 0)", "x between 4 and 9", "x < 3 or x > 14"),
    ("variety", "case when n_words between 20 and 2000 then 100.0 * n_distinct / n_words end", "x >= 45", "x < 20"),
    ("lines", "case when n_lines >= 3 then 100.0 * n_dup_lines / n_lines end", "x <= 5", "x > 30"),
    ("shouting", "100.0 * n_shouts / nullif(n_words, 0)", None, "x > 15"),
    ("same_word", "100.0 * n_same / nullif(n_words, 0)", None, "x > 10"),
    ("plain_words", "100.0 * n_plain / nullif(n_words, 0)", "x >= 85", "x < 60"),
    ("lone_marks", "100.0 * n_lone / nullif(n_words, 0)", None, "x > 8"),
    ("endings", "100.0 * n_odd_ends / nullif(n_words, 0)", "x <= 3", "x > 15"),
)

#: Where estimation starts: how often a rule votes bad, abstains, votes good.
START_GOOD = (0.02, 0.38, 0.6)
START_BAD = (0.3, 0.3, 0.4)


def _count_of(text: Column, chars: str) -> Column:
    """Characters of ``text`` that are in ``chars``."""
    rest = text
    for c in chars:
        rest = F.replace(rest, F.lit(c))
    return F.length(text) - F.length(rest)


def features(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Counts of every text; all of them linear in its length, but for a sort
    of the window hashes of texts that do repeat a five-word window."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    d = d.select("doc_id", "t", words(F.col("t")).alias("ws"))
    d = d.select(
        "doc_id",
        F.transform("ws", lambda w: F.xxhash64(w)).alias("h"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length(F.array_join("ws", "")).cast("long").alias("word_chars"),
        _count_of(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        _count_of(F.col("t"), "!").cast("long").alias("n_shouts"),
        _count_of(F.col("t"), ".").cast("long").alias("n_stops"),
        _count_of(F.col("t"), ",").cast("long").alias("n_commas"),
        F.regexp_count("t", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        *[F.regexp_count("t", F.lit(pattern)).cast("long").alias(name)      # whole words of the text
          for name, pattern in (("n_plain", PLAIN), ("n_lone", LONE), ("n_odd_ends", ODD_END))])
    d = d.select(
        "doc_id", "word_chars", "n_symbols", "n_shouts", "n_stops", "n_commas", "n_capitals", "h",
        F.size(F.array_distinct("h")).cast("long").alias("n_distinct"), "n_plain", "n_lone", "n_odd_ends",
        F.size("h").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("h", lambda x, i: F.get("h", i + 1) == x)).cast("long").alias("n_same"),
        F.transform(F.slice("h", F.lit(1), F.greatest(F.size("h") - 4, F.lit(0))),
                    lambda x, i: F.xxhash64(x, *[F.get("h", i + k) for k in range(1, 5)])).alias("win"))
    # Sorted (window, place) only where some window repeats; places of windows
    # that equal a neighbour, then the length of the union of their five words.
    repeated = F.size(F.array_distinct("win")) < F.size("win")
    d = d.withColumn("win", F.when(repeated, F.sort_array(F.transform(
        "win", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    d = d.withColumn("at", F.sort_array(F.transform(
        F.filter("win", lambda s, k: F.coalesce(
            (F.get("win", k - 1)["x"] == s["x"]), F.lit(False))
            | F.coalesce(F.get("win", k + 1)["x"] == s["x"], F.lit(False))),
        lambda s: s["i"])))
    covered = F.aggregate(
        F.transform("at", lambda p, k: F.least(F.lit(5), F.coalesce(F.get("at", k + 1) - p, F.lit(5)))),
        F.lit(0), lambda a, x: a + x)
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
                    "n_lines", "n_shouts", "n_same", "n_stops", "n_commas", "n_capitals", "n_distinct",
                    "n_plain", "n_lone", "n_odd_ends")


def votes(feats: DataFrame, rules=RULES) -> DataFrame:
    """A column ``vote_<rule>`` for each rule: 1, 0 or -1."""
    def vote(measure, good, bad):
        cases = [f"when {test.replace('x', f'({measure})')} then {v}" for test, v in ((bad, -1), (good, 1)) if test]
        return F.expr(f"case {' '.join(cases)} else 0 end")
    return feats.withColumns({f"vote_{name}": vote(m, good, bad) for name, m, good, bad in rules})


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, x: a + x)


def posterior(vote: Column, good: Column, bad: Column, share: Column) -> Column:
    """P(good | votes). ``good`` and ``bad`` are flat arrays of the rates, three
    a rule: how often it votes -1, 0, 1."""
    def log_rate(rates):
        return _sum(F.transform(vote, lambda v, j: F.log(F.get(rates, 3 * j + v + 1))))
    return 1 / (1 + F.exp(F.log((1 - share) / share) + log_rate(bad) - log_rate(good)))


def fit(voted: DataFrame, cols: list[str], rounds: int = 30, share: float = 0.8,
        pseudo: float = 10.0) -> tuple[list[float], list[float], float]:
    """(rates on good texts, rates on bad texts, share of good texts) by
    expectation-maximisation.

    Works on the counts of distinct vote patterns, at most 3 ** rules rows
    whatever the input, and is one expression over them. ``pseudo`` texts of each
    quality that vote at the starting rates are added to each estimate, so no rate
    is 0, and an empty table gives the starting values. Nothing else bounds them.
    """
    counts = voted.groupBy(F.array(*cols).alias("v")).agg(F.count("*").cast("double").alias("n"))
    patterns = counts.agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("pats"))
    start = [F.array(*[F.lit(float(x)) for x in rates] * len(cols)) for rates in (START_GOOD, START_BAD)]
    cells = F.sequence(F.lit(0), F.lit(3 * len(cols) - 1))

    def step(state, _):
        # expectation: the posterior of each pattern; maximisation: weighted shares
        post = F.transform("pats", lambda p: F.struct(
            p["v"].alias("v"), p["n"].alias("n"),
            (p["n"] * posterior(p["v"], state["good"], state["bad"], state["share"])).alias("q")))

        def update(ps):
            all_good = _sum(F.transform(ps, lambda p: p["q"]))
            total = _sum(F.transform(ps, lambda p: p["n"]))

            def rates(weight, mass, first):
                def rate(k):
                    said = F.filter(ps, lambda p: F.get(p["v"], F.floor(k / 3).cast("int")) == k % 3 - 1)
                    return (_sum(F.transform(said, weight)) + pseudo * F.get(first, k)) / (mass + pseudo)
                return F.transform(cells, rate)
            return F.struct(rates(lambda p: p["q"], all_good, start[0]).alias("good"),
                            rates(lambda p: p["n"] - p["q"], total - all_good, start[1]).alias("bad"),
                            ((all_good + pseudo * share) / (total + pseudo)).alias("share"))
        return F.element_at(F.transform(F.array(post), update), 1)

    first = F.struct(start[0].alias("good"), start[1].alias("bad"), F.lit(share).alias("share"))
    row = patterns.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), first, step).alias("m")).first()
    return list(row["m"]["good"]), list(row["m"]["bad"]), row["m"]["share"]


def score(docs: DataFrame, id_col="doc_id", text_col="text", rules=RULES, keep_at: float = 0.5) -> DataFrame:
    """Features, ``base_failed``, the votes, ``posterior`` and ``kept`` of every row."""
    voted = stage(votes(features(docs, id_col, text_col), rules), "votes")
    cols = [f"vote_{r[0]}" for r in rules]
    good, bad, share = fit(voted, cols)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    p = F.round(posterior(F.array(*cols), F.array(*map(F.lit, good)), F.array(*map(F.lit, bad)), F.lit(share)), 9)
    return (voted.withColumn("base_failed", failed).withColumn("posterior", p)
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_at)))
