"""Quality rules by weak supervision: rules vote or abstain, EM estimates their accuracies, a posterior decides.

Everything is built-in expressions and one aggregate over vote patterns. With m rules there are at most 3^m patterns,
whatever the number of documents, so the EM runs as a fold over one row.

Null text counts as empty. Empty text has 0 in every count and fails the base rules. Rows are scored one by one: equal
rows, ties and null ids get equal results. An empty table gives an empty result. Columns besides the id and the text
are not read, and `keep` returns them unchanged.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from gleaner.sources.staging import stage

# White space between words, counted symbols, base limits.
SPACE = r"[\\x20\\x09-\\x0D]+"
WORD = r"[^\\x20\\x09-\\x0D]"
SPACES, SYMBOLS = r" \t\n\u000B\u000C\r", "#*$%&|<>"
WINDOW = 5
BASE_FAILED = "{m}.n_words < 10 or 100 * {m}.n_repeat_words > 20 * {m}.n_words"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: (bad, good): SQL conditions on the measures `m`; a rule abstains when neither holds.
RULES = {
    "symbols": ("4 * {m}.n_symbols > {m}.n_words", "50 * {m}.n_symbols <= {m}.n_words"),
    "letters": ("{m}.word_chars >= 250 and 10 * {m}.n_letters < 8 * {m}.word_chars", "100 * {m}.n_letters > 93 * {m}.word_chars"),
    "capitals": ("10 * {m}.n_capitals > 4 * {m}.n_letters", "false"),
    "repeats": ("100 * {m}.n_repeat_words > 15 * {m}.n_words", "false"),
    "dup_lines": ("{m}.n_lines >= 3 and 10 * {m}.n_dup_lines > 4 * {m}.n_lines", "false"),
    "word_length": ("2 * {m}.word_chars < 5 * {m}.n_words or 2 * {m}.word_chars > 25 * {m}.n_words", "false"),
}


@dataclass(frozen=True)
class Model:
    """Accuracy of each rule when it votes, and the prior probability of good quality."""
    accuracy: dict[str, float]
    prior: float


def _let(value: str, name: str, body: str) -> str:
    # Binds a value to a lambda variable, so that it is evaluated once and not for each element or use.
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _repeat_words(words: str) -> str:
    """Number of words inside 5-word windows that occur twice or more among `words`."""
    window = ", ".join(f"a[i + {k}]" for k in range(WINDOW))
    hashes = _let(f"transform({words}, w -> xxhash64(w))", "a",
                  f"if(size(a) < {WINDOW}, array(), transform(sequence(0, size(a) - {WINDOW}), i -> xxhash64({window})))")
    twins = "(k > 0 and get(s, k - 1).h = x.h) or (k < size(s) - 1 and get(s, k + 1).h = x.h)"
    starts = _let("sort_array(transform(g, (h, i) -> struct(h as h, i as i)))", "s",
                  f"sort_array(transform(filter(s, (x, k) -> {twins}), x -> x.i))")
    covered = (f"aggregate({starts}, struct(0 as e, 0 as t), "
               f"(c, i) -> struct(i + {WINDOW} as e, c.t + i + {WINDOW} - greatest(c.e, i) as t), c -> c.t)")
    return _let(hashes, "g", f"if(size(array_distinct(g)) = size(g), 0, {covered})")


def _measures(text: str) -> str:
    """SQL for the struct of base counts and further measures of a text."""
    kind = lambda name: f"length(regexp_replace(t, '[^\\\\p{{{name}}}]+', ''))"
    fields = {
        "n_words": "size(ws)", "word_chars": f"length(translate(t, '{SPACES}', ''))",
        "n_symbols": f"length(t) - length(translate(t, '{SYMBOLS}', ''))",
        "n_dup_lines": "size(ls) - size(array_distinct(ls))", "n_repeat_words": _repeat_words("ws"),
        "n_lines": "size(ls)", "n_letters": kind("L"), "n_capitals": kind("Lu"),
    }
    record = "struct(" + ", ".join(f"cast({sql} as bigint) as {name}" for name, sql in fields.items()) + ")"
    lines = _let(f"filter(split(t, '\\\\n'), l -> l rlike '{WORD}')", "ls", record)
    words = _let(f"filter(split(t, '{SPACE}'), w -> w <> '')", "ws", lines)
    return _let(f"coalesce({text}, '')", "t", words)


def _vote(rule: str, m: str) -> str:
    """1 for good, -1 for bad, 0 where the rule abstains."""
    bad, good = (condition.format(m=m) for condition in RULES[rule])
    return f"case when {m}.n_words = 0 then 0 when {bad} then -1 when {good} then 1 else 0 end"


def _posterior(vote_of, accuracy_of, prior: str) -> str:
    odds = [f"ln({prior} / (1 - {prior}))"]
    odds += [f"{vote_of(r)} * ln({accuracy_of(r)} / (1 - {accuracy_of(r)}))" for r in RULES]
    return f"1 / (1 + exp(-({' + '.join(odds)})))"


def _scored(model: Model, m: str) -> str:
    return _posterior(lambda r: f"({_vote(r, m)})", lambda r: f"double({model.accuracy[r]!r})", f"double({model.prior!r})")


def measures(docs: DataFrame, text: str = "text", kept: tuple[str, ...] = ()) -> DataFrame:
    """The columns `kept` and a struct `m` of the text's measures."""
    return docs.select(*[F.col(c) for c in kept], F.expr(_measures(f"`{text}`")).alias("m"))


def fit(measured: DataFrame, rounds: int = 20, start: float = 0.9, prior: float = 0.5, smoothing: float = 10.0,
        low: float = 0.55, high: float = 0.99) -> Model:
    """Estimate the rules' accuracies by EM over the counts of the vote patterns of all rows.

    The prior stays at `prior`. Accuracies start at `start`, are smoothed by that many votes and kept within
    [low, high]: a rule is better than a coin, so the two classes can't swap. Without rows the start values are kept.
    """
    rules = list(RULES)
    patterns = (measured.select(*[F.expr(_vote(r, "m")).alias(r) for r in rules])
                .groupBy(*rules).agg(F.count(F.lit(1)).alias("n")))
    rows = patterns.agg(F.sort_array(F.collect_list(F.struct(*rules, "n"))).alias("patterns"))  # at most 3^rules
    good = _posterior(lambda r: f"p.{r}", lambda r: f"s.{r}", f"double({prior})")
    weighed = f"transform(patterns, p -> struct(p as p, {good} as q))"
    total = lambda value: f"aggregate(e, double(0), (t, x) -> t + double({value}))"
    right = lambda r: f"x.p.n * if(x.p.{r} = 1, x.q, if(x.p.{r} = -1, 1 - x.q, double(0)))"
    accuracies = ", ".join(
        f"least(double({high}), greatest(double({low}), ({total(right(r))} + double({smoothing * start})) / "
        f"({total(f'x.p.n * abs(x.p.{r})')} + double({smoothing})))) as {r}" for r in rules)
    first = ", ".join(f"double({start}) as {r}" for r in rules)
    fold = f"aggregate(sequence(1, {rounds}), struct({first}), (s, k) -> {_let(weighed, 'e', f'struct({accuracies})')})"
    return Model(rows.select(F.expr(fold).alias("found")).select("found.*").first().asDict(), prior)


def assess(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: key, base counts, further measures, votes, posterior, base_failed, kept."""
    rows = stage(measures(docs, text, (key,)), "quality")
    model = fit(rows)
    voted = rows.select(key, "m.*", *[F.expr(_vote(r, "m")).alias(f"vote_{r}") for r in RULES],
                        F.expr(_scored(model, "m")).alias("posterior"),
                        F.expr(BASE_FAILED.format(m="m")).alias("base_failed"))
    return voted.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def keep(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that `assess` would keep, with all their columns; two scans, and no shuffle of the text."""
    model = fit(measures(docs, text))
    verdict = f"not ({BASE_FAILED.format(m='m')}) and {_scored(model, 'm')} >= double({threshold})"
    return docs.filter(F.expr(_let(_measures(f"`{text}`"), "m", verdict)))
