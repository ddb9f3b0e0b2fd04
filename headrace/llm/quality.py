"""Quality by weak supervision: rules vote or abstain, and their votes are weighed.

Rules vote good (1), bad (0) or abstain (-1) from measures of the whole text. Two-class
expectation-maximisation over the vote patterns of all documents estimates how often each
rule is right about good and about bad documents; the posterior probability of a
document's pattern decides. At most 3^7 patterns exist, however many documents there are.

Everything is DataFrame and SQL functions. Repeated three-word windows are found inside
each row by sorting its window hashes, so no word is shuffled. Null text has no words;
without words every rule abstains. An empty table gives an empty result. Only ``doc_id``
and ``text`` are read, and repeated rows give repeated results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm import frames

# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SPACE = "[\\\\x20\\\\x09-\\\\x0D]+"

# The rules: when they vote good, when bad; else they abstain.
RULES = {
    "long_enough": ("n_words >= 80", "n_words < 30"),
    "word_length": ("word_chars between 3 * n_words and 9 * n_words",
                    "word_chars < 2 * n_words or word_chars > 14 * n_words"),
    "few_symbols": ("20 * n_symbols <= n_words", "5 * n_symbols > n_words"),
    "clean_words": ("50 * n_symbols <= word_chars", "12 * n_symbols > word_chars"),
    "new_lines": ("n_lines >= 2 and n_dup_lines = 0", "4 * n_dup_lines > n_lines"),
    "new_windows": ("10 * n_repeat_words <= n_words", "10 * n_repeat_words > 3 * n_words"),
    "rich_words": ("5 * n_distinct >= 2 * n_words", "5 * n_distinct < n_words"),
}

ROUNDS = 25
PRIOR = 0.8
# Where estimation begins: a rule seldom condemns a good document, but junk fails only some.
RIGHT_ON_GOOD = 0.95
RIGHT_ON_BAD = 0.4
# Added as seen votes, half right, so that no estimate reaches 0 or 1.
SMOOTHING = 1.0


def measures(docs: DataFrame) -> DataFrame:
    """Counts of each text that the rules use."""
    words = (
        frames.texts(docs)
        .withColumn("text", F.coalesce("text", F.lit("")))
        .selectExpr(
            "doc_id",
            f"array_remove(split(text, '{SPACE}'), '') as w",
            f"filter(split(text, '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]') as lines",
        )
        .selectExpr("*", "size(w) as n", "array_join(w, '') as joined")
    )
    bare = "joined"
    for symbol in SYMBOLS:
        bare = f"replace({bare}, '{symbol}', '')"
    windows = (
        "if(n < 3, array(), transform(sequence(0, n - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])))"
    )
    counted = words.selectExpr(
        "doc_id",
        "cast(n as long) as n_words",
        "cast(char_length(joined) as long) as word_chars",
        f"cast(char_length(joined) - char_length({bare}) as long) as n_symbols",
        "cast(size(lines) as long) as n_lines",
        "cast(size(lines) - size(array_distinct(lines)) as long) as n_dup_lines",
        "cast(size(array_distinct(w)) as long) as n_distinct",
        f"cast({windows} as array<bigint>) as g",
    )
    # Values met twice or more, and the places of the windows that have them.
    twice = counted.selectExpr(
        "*", "if(size(array_distinct(g)) = size(g), null, sort_array(transform(g, (x, i) -> struct(x, i)))) as s"
    ).selectExpr(
        "*",
        "sort_array(transform(filter(s, (e, i) -> get(s, i - 1).x <=> e.x or get(s, i + 1).x <=> e.x), e -> e.i)) as at",
    )
    covered = (
        "aggregate(at, named_struct('n', 0, 'until', 0), "
        "(a, x) -> named_struct('n', a.n + x + 3 - greatest(a.until, x), 'until', x + 3), a -> a.n)"
    )
    return twice.selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_distinct",
        f"cast(coalesce({covered}, 0) as long) as n_repeat_words",
    )


def votes(measured: DataFrame) -> DataFrame:
    """Adds ``votes``, one per rule in the order of ``RULES``."""
    each = [
        f"case when n_words = 0 then -1 when {good} then 1 when {bad} then 0 else -1 end"
        for good, bad in RULES.values()
    ]
    return measured.selectExpr("*", f"array({', '.join(each)}) as votes")


def _let(value: str, name: str, body: str) -> str:
    """An expression with a value computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _log_odds(vote: str, state: str) -> str:
    return (
        f"aggregate(sequence(0, {len(RULES) - 1}), ln({state}.prior / (1 - {state}.prior)), "
        f"(sum, j) -> sum + case {vote}[j] "
        f"when 1 then ln({state}.good[j] / (1 - {state}.bad[j])) "
        f"when 0 then ln((1 - {state}.good[j]) / {state}.bad[j]) else 0D end)"
    )


def posteriors(voted: DataFrame) -> DataFrame:
    """``votes``, ``n`` documents that cast them, and their ``posterior`` of being good."""
    patterns = (
        voted.groupBy("votes")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
        .agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("p"))
        .where("size(p) > 0")
    )
    last = len(RULES) - 1
    weights = f"transform(p, x -> 1 / (1 + exp(-({_log_odds('x.votes', 's')}))))"

    def right(vote: int, share: str) -> str:
        """How often each rule votes so among the documents of one class it votes on."""
        total = "aggregate(sequence(0, size(p) - 1), {0}D, (a, i) -> a + if({1}, p[i].n * {2}, 0D))"
        voted_so = total.format(SMOOTHING / 2, f"p[i].votes[j] = {vote}", share)
        voted_any = total.format(SMOOTHING, "p[i].votes[j] >= 0", share)
        return f"transform(sequence(0, {last}), j -> {voted_so} / {voted_any})"

    sums = "aggregate(sequence(0, size(p) - 1), {0}D, (a, i) -> a + p[i].n * {1})"
    prior = f"{sums.format(SMOOTHING / 2, 'q[i]')} / {sums.format(SMOOTHING, '1D')}"
    step = _let(
        weights, "q",
        f"named_struct('prior', {prior}, 'good', {right(1, 'q[i]')}, 'bad', {right(0, '(1 - q[i])')})",
    )
    good, bad = (f"array_repeat({x}D, {last + 1})" for x in (RIGHT_ON_GOOD, RIGHT_ON_BAD))
    start = f"named_struct('prior', {PRIOR}D, 'good', {good}, 'bad', {bad})"
    fitted = patterns.selectExpr("p", f"aggregate(sequence(1, {ROUNDS}), {start}, (s, k) -> {step}) as s")
    return fitted.selectExpr("inline(transform(p, x -> named_struct('votes', x.votes, 'n', x.n, "
                             f"'posterior', 1 / (1 + exp(-({_log_odds('x.votes', 's')}))))))")  # fmt: skip


def rate(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Measures, votes and posterior of every document, and whether it is kept."""
    voted = frames.stored(votes(measures(docs)), "quality")
    weighed = F.broadcast(posteriors(voted).select("votes", "posterior"))  # at most 3^7 rows
    failed = f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
    return voted.join(weighed, "votes").selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        f"({failed}) as base_failed",
        f"(not ({failed}) and posterior >= {threshold}) as kept",
        "posterior", "votes",
    )
