"""Quality by weak supervision: rules vote or abstain, and a label model weighs their votes.

Each rule looks at a few measures of a text and votes to keep it, to reject it, or abstains.  Nobody says how
good a rule is: expectation maximisation estimates, from how the rules agree over
all documents, how often each is right on good and on bad texts, and the share of good ones.
A document's posterior probability of being good then replaces the demand that it pass every rule.

Everything is built of SQL expressions.  The measures are one narrow pass.  Documents that got
the same votes are the same to the model, so it works on the counts of vote patterns, of
which there are at most 3 to the number of rules at any size; a round is one aggregate over them.

Null texts have no words, and like empty and blank ones fail the length rule.  Very long texts are handled
within their row.  Repeated rows are each counted and returned; null ids stay.  An empty
table gives no rows.  Columns of the input besides id and text are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.frames import stored

# The white space that parts words, and symbols that prose has few of.
SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MARKS = "!\"#$%&'()*+,-./0123456789:;<=>?@[\\]^_`{|}~"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ABSTAIN, REJECT, KEEP = -1, 0, 1

# Documents of a lower probability of being good go.  Losing a good text costs more than keeping a poor one.
THRESHOLD = 0.02


@dataclass(frozen=True)
class Rule:
    """Votes to reject above ``bad`` and to keep below ``good`` (the other way round if falling)."""

    name: str
    measure: str  # SQL over the measures
    bad: float
    good: float
    falling: bool = False

    def vote(self) -> Column:
        value = F.expr(self.measure)
        reject = value < self.bad if self.falling else value > self.bad
        keep = value >= self.good if self.falling else value <= self.good
        return F.when(reject, REJECT).when(keep, KEEP).otherwise(ABSTAIN).cast("int")


RULES = (
    Rule("length", "n_words", 50, 100, falling=True),
    Rule("repeated_windows", "n_repeat_words / greatest(n_words, 1)", 0.5, 0.2),
    Rule("symbols", "n_symbols / greatest(n_words, 1)", 0.2, 0.05),
    Rule("marks", "n_marks / greatest(word_chars, 1)", 0.12, 0.06),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", 0.3, 0.1),
    Rule("word_length", "word_chars / greatest(n_words, 1)", 12, 9),
    Rule("capitals", "n_capitals / greatest(word_chars, 1)", 0.3, 0.12),
    Rule("distinct_words", "n_distinct / greatest(sqrt(n_words), 1)", 4.0, 6.0, falling=True),
    Rule("exclamations", "n_exclamations / greatest(n_words, 1)", 0.2, 0.05),
)


def _removed(text: Column, characters: str) -> Column:
    """How many of the characters the text has."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _let(value: Column, use) -> Column:
    """Evaluate a value once and use it in an expression."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column) -> Column:
    """Words inside windows of three words that the text has at least twice."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"),
            i.alias("at"),
        ),
    )

    def again(ordered: Column) -> Column:
        return F.filter(
            ordered,
            lambda x, i: (x["h"] == F.get(ordered, i + 1)["h"])
            | ((i > 0) & (x["h"] == F.get(ordered, i - 1)["h"])),
        )

    places = F.sort_array(
        F.transform(_let(F.sort_array(windows), again), lambda x: x["at"])
    )
    count = F.aggregate(
        places,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, at: F.struct(
            (at + 3).alias("end"), (acc["n"] + at + 3 - F.greatest(acc["end"], at)).alias("n")
        ),
        lambda acc: acc["n"].cast("long"),
    )
    return F.when(F.size(words) >= 3, count).otherwise(F.lit(0).cast("long"))


def measures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The counts that the rules look at, one row per document."""
    text = F.col("text")
    return (
        docs.select(
            F.col(id_column), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
        )
        .withColumn("body", F.btrim("text", F.lit(SPACE)))
        .withColumn(
            "words",
            F.when(F.col("body") == "", F.array().cast("array<string>")).otherwise(
                F.split("body", SPACE_CLASS)
            ),
        )
        .withColumn(
            "lines",
            F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != ""),
        )
        .select(
            id_column,
            F.size("words").cast("long").alias("n_words"),
            F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
            _removed(text, SYMBOLS).alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            _repeat_words(F.col("words")).alias("n_repeat_words"),
            F.size("lines").cast("long").alias("n_lines"),
            F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
            _removed(text, MARKS).alias("n_marks"),
            _removed(text, CAPITALS).alias("n_capitals"),
            _removed(text, "!").alias("n_exclamations"),
        )
    )


@dataclass(frozen=True)
class LabelModel:
    """The share of good documents and, per rule, the chance of each vote on either kind.

    The chances are of (reject, keep); what is left is the chance that the rule abstains.
    """

    good: float
    on_good: tuple[tuple[float, float], ...]
    on_bad: tuple[tuple[float, float], ...]

    def posterior(self, votes: list[str]) -> Column:
        """The probability that a document is good, given its votes."""
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for vote, g, b in zip(votes, self.on_good, self.on_bad, strict=True):
            odds = odds + F.when(F.col(vote) == REJECT, math.log(g[0] / b[0])).when(
                F.col(vote) == KEEP, math.log(g[1] / b[1])
            ).otherwise(math.log((1 - sum(g)) / (1 - sum(b))))
        return 1 / (1 + F.exp(-odds))

    def accuracies(self) -> list[float]:
        """How often each rule's votes are right, abstentions aside."""
        found = []
        for g, b in zip(self.on_good, self.on_bad, strict=True):
            right = self.good * g[1] + (1 - self.good) * b[0]
            found.append(right / (right + self.good * g[0] + (1 - self.good) * b[1]))
        return found


def revised(total: float, share: float, sums: list[float]) -> LabelModel:
    """The model that fits the expected counts best.

    ``sums`` has four numbers per rule: expected good documents it rejected and kept, and bad
    ones.  Every rate starts from a belief worth ten documents: good texts are hardly ever rejected, and most
    rules find nothing wrong with a bad one.  A rule cannot be worse than chance:
    where its votes say the opposite of their name they are taken to say nothing, which also
    fixes which of the two kinds is the good one.
    """
    bad = total - share
    on_good, on_bad = [], []
    for at in range(0, len(sums), 4):
        rejected, kept, caught, missed = sums[at : at + 4]
        g = [(rejected + 0.2) / (share + 10), (kept + 7) / (share + 10)]
        b = [(caught + 4) / (bad + 10), (missed + 5) / (bad + 10)]
        if g[0] > b[0]:
            g[0] = b[0] = (rejected + caught + 4.2) / (total + 20)
        if g[1] < b[1]:
            g[1] = b[1] = (kept + missed + 12) / (total + 20)
        on_good.append(tuple(g))
        on_bad.append(tuple(b))
    return LabelModel((share + 8) / (total + 10), tuple(on_good), tuple(on_bad))


def fit_label_model(
    voted: DataFrame, votes: list[str], *, rounds: int = 25, tolerance: float = 1e-4
) -> LabelModel:
    """Expectation maximisation over the counts of vote patterns."""
    patterns = stored(voted.groupBy(*votes).agg(F.count("*").alias("n")), "vote-patterns")
    model = revised(0.0, 0.0, [0.0] * 4 * len(votes))
    for _ in range(rounds):
        expected = patterns.withColumn("p", model.posterior(votes))
        good, bad = F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p"))
        sums = [F.sum("n"), F.sum(good)]
        for vote in votes:
            for share in (good, bad):
                for cast in (REJECT, KEEP):
                    sums.append(F.sum(F.when(F.col(vote) == cast, share)))
        total, share, *rest = [float(x or 0) for x in expected.agg(*sums).first()]
        found = revised(total, share, rest)
        moved = max(
            abs(x - y)
            for x, y in zip(_numbers(found), _numbers(model), strict=True)
        )
        model = found
        if moved < tolerance:
            break
    return model


def _numbers(model: LabelModel) -> list[float]:
    return [model.good, *[x for pair in (*model.on_good, *model.on_bad) for x in pair]]


def judge(
    docs: DataFrame,
    *,
    rules: tuple[Rule, ...] = RULES,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The measures of every document, its votes, its posterior quality, and ``good``.

    ``base_failed`` marks documents that fail the plain limits.  They are judged too, but
    the label model is fitted on the others: the limits settle them, and being alike in
    failing them they would be taken for the bad kind.
    """
    votes = [f"vote_{rule.name}" for rule in rules]
    voted = stored(
        measures(docs, id_column, text_column)
        .withColumn("base_failed", base_failed())
        .select("*", *[rule.vote().alias(name) for rule, name in zip(rules, votes, strict=True)]),
        "votes",
    )
    model = fit_label_model(voted.where(~F.col("base_failed")), votes)
    return voted.withColumn("quality", model.posterior(votes)).withColumn(
        "good", F.col("quality") >= threshold
    )


def base_failed() -> Column:
    """The plain limits: too short, or mostly repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
