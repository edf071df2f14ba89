"""Quality rules as weak supervision: rules vote or abstain, and their accuracies are estimated.

A rule says "good", "bad" or nothing about a text. No rule is trusted by itself: expectation-
maximisation over the votes of all documents estimates, without labels, how often each
rule calls good and bad texts bad, and with that the probability that a text is good. A rule that
abstains, as most do on short texts, says nothing either way. Only the number of documents for each pattern of votes is needed for it, at most
``3 ** len(RULES)`` rows however many documents there are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import fresh, hashes, small, windows

BLANK_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WORDS = 5
#: frequent function words of the four languages
STOP_WORDS = frozenset(w.encode() for w in (
    "the of and to in that is was for it with as be this from by are on not or at which have "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine als auch es "
    "de la que el en y los del las por un para con no una su al lo como "
    "le les et des est dans qui du pour pas au sur plus par une").split())
_BIG = bytes(range(65, 91))
_LETTERS = _BIG + bytes(range(97, 123))


@dataclass(frozen=True)
class Traits:
    """What the rules see of a text; counts are exact and cover the whole text."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lines: int
    n_distinct: int
    n_stop: int
    n_marks: int
    n_shouts: int
    letters: int
    capitals: int

    @property
    def base_failed(self) -> bool:
        return self.n_words < 10 or 100 * self.n_repeat_words > 20 * self.n_words


def traits(text: str | None) -> Traits:
    text = text or ""
    raw = text.encode()
    words = raw.split()
    full = [x for x in text.split("\n") if x.strip(BLANK_CHARS)]
    repeated = 0
    if len(words) >= WORDS:
        _, kind, count = np.unique(windows(hashes(words), WORDS), return_inverse=True, return_counts=True)
        edge = np.zeros(len(words) + 1, np.int32)
        start = np.flatnonzero(count[kind] > 1)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + WORDS, -1)
        repeated = int(np.count_nonzero(np.cumsum(edge[:-1])))
    return Traits(
        n_words=len(words), word_chars=len(text) - sum(map(text.count, BLANK_CHARS)),
        n_symbols=sum(map(text.count, SYMBOLS)), n_dup_lines=len(full) - len(set(full)), n_repeat_words=repeated,
        n_lines=len(full), n_distinct=len(set(words)), n_stop=sum(map(STOP_WORDS.__contains__, words)),
        n_marks=text.count(".") + text.count(",") + text.count(";"), n_shouts=text.count("!"),
        letters=len(raw) - len(raw.translate(None, _LETTERS)), capitals=len(raw) - len(raw.translate(None, _BIG)))



def _share(a: float, b: float) -> float:
    return a / b if b else 0.0


#: each takes Traits and returns 1 (good), -1 (bad) or 0 (abstains)
RULES = {
    "symbols": lambda t: _band(_share(t.n_symbols, t.n_words), 0.02, 0.2),
    "capitals": lambda t: _band(_share(t.capitals, t.letters), 0.15, 0.4) if t.letters >= 20 else 0,
    "shouting": lambda t: _band(_share(t.n_shouts, t.n_words), 0.1, 0.25),
    "duplicate lines": lambda t: _band(_share(t.n_dup_lines, t.n_lines), 0.05, 0.4) if t.n_lines > 2 else 0,
    "repeated passages": lambda t: _band(_share(t.n_repeat_words, t.n_words), 0.05, 0.2),
    "vocabulary": lambda t: _falling(_share(t.n_distinct, t.n_words), 0.45, 0.15) if 30 <= t.n_words <= 2000 else 0,
    "function words": lambda t: _falling(_share(t.n_stop, t.n_words), 0.05, 0.01) if t.n_words >= 30 else 0,
    "word length": lambda t: (1 if 3 <= _share(t.word_chars, t.n_words) <= 8 else
                              -1 if not 2 <= _share(t.word_chars, t.n_words) <= 14 else 0),
    "sentences": lambda t: _falling(_share(t.n_marks, t.n_words), 0.05, 0.002) if t.n_words >= 50 else 0,
}


def _band(x: float, good_to: float, bad_from: float) -> int:
    return 1 if x <= good_to else -1 if x > bad_from else 0


def _falling(x: float, good_from: float, bad_to: float) -> int:
    return 1 if x >= good_from else -1 if x < bad_to else 0


def votes(t: Traits) -> bytes:
    """The votes as one byte a rule: 0 bad, 1 abstains, 2 good."""
    return bytes(rule(t) + 1 for rule in RULES.values())


@dataclass(frozen=True)
class Model:
    """prior: share of good texts; accuracy[rule, class, vote] with class 1 good, and 1 for abstaining."""

    prior: float
    accuracy: np.ndarray

    def posterior(self, pattern: bytes) -> float:
        """Probability that a text with these votes is good."""
        rule = np.arange(len(pattern))
        log = np.log(self.accuracy[rule, :, list(pattern)]).sum(0) + np.log([1 - self.prior, self.prior])
        return float(1 / (1 + np.exp(log[0] - log[1])))


def estimate(counts: dict[bytes, int], rounds: int = 200) -> Model:
    """Prior and accuracies that make the votes of all documents most likely.

    It starts from rules that seldom call a good text bad. One observation's worth of that start stays
    in the estimate, so an empty table or a rule that always abstains has a defined result.
    """
    start = np.array([[[0.4, 0, 0.6], [0.01, 0, 0.99]]] * len(RULES))
    model = Model(0.8, start + np.array([0, 1, 0]))
    if not counts:
        return model
    patterns = sorted(counts)
    seen = np.array([list(p) for p in patterns])
    n = np.array([counts[p] for p in patterns], float)
    rule = np.arange(len(RULES))[None, :]
    for _ in range(rounds):
        log = np.log(model.accuracy)[rule, :, seen].sum(1) + np.log([1 - model.prior, model.prior])
        good = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))
        table = start.copy()
        for vote in (0, 2):
            hit = (seen == vote) * n[:, None]
            table[:, 1, vote] += (hit * good[:, None]).sum(0)
            table[:, 0, vote] += (hit * (1 - good)[:, None]).sum(0)
        prior = (0.8 + (n * good).sum()) / (1 + n.sum())
        table /= table.sum(2, keepdims=True)
        table[:, :, 1] = 1
        new = Model(float(prior), table)
        moved = max(abs(new.prior - model.prior), float(np.abs(new.accuracy - model.accuracy).max()))
        model = new
        if moved < 1e-7:
            break
    return model


def fit(docs: DataFrame) -> Model:
    """Estimate the model from the votes of every document of ``docs`` (text)."""
    def run(batches):
        for batch in small(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array([votes(traits(t)) for t in batch.column("text").to_pylist()], pa.binary())], ["votes"])

    counted = docs.select("text").mapInArrow(run, "votes binary").groupBy("votes").agg(F.count("*").alias("n"))
    return estimate({bytes(r["votes"]): r["n"] for r in counted.collect()})


#: name and type of what ``judge`` adds
ADDED = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
         "base_failed": "boolean", "quality": "double", "kept": "boolean"}


def judge(docs: DataFrame, model: Model | None = None, least: float = 0.5) -> DataFrame:
    """``docs`` with the traits, the probability ``quality`` that a text is good, and ``kept``.

    ``kept`` is false below ten words or with over 20 % of the words in repeated five-word windows
    (``base_failed``), else true from a probability of ``least``. Each row is judged by its own text: repeated rows
    get equal verdicts, null texts count as empty and fail, other columns (``doc_id`` may be null)
    pass through. An added column whose name is taken gets a ``_`` suffix.
    """
    model = model or fit(docs)
    names = {k: fresh(docs, k) for k in ADDED}
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
                        *(f"`{names[k]}` {kind}" for k, kind in ADDED.items())])

    columns = [*docs.columns, *names.values()]

    def run(batches):
        known: dict[bytes, float] = {}
        for batch in small(batches, "text"):
            found = [traits(t) for t in batch.column("text").to_pylist()]
            patterns = [votes(t) for t in found]
            for p in set(patterns) - known.keys():
                known[p] = model.posterior(p)
            quality = [known[p] for p in patterns]
            made = [pa.array([getattr(t, k) for t in found], pa.int64()) for k in list(ADDED)[:5]]
            made += [pa.array([t.base_failed for t in found]), pa.array(quality, pa.float64()),
                     pa.array([not t.base_failed and q >= least for t, q in zip(found, quality, strict=True)])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], columns)

    return docs.mapInArrow(run, schema)
