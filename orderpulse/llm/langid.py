"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained here, in numpy, by backpropagation through time on a bounded sample of labelled text windows.  It
reads the UTF-8 bytes of a whole text in windows of ``WINDOW`` bytes from both ends, gives every position a probability
for each language, and a document's probabilities are the mean over the positions that belong to letters.

A network that was only shown some languages is sure of one of them on any text.  :func:`drop_unidentified` therefore also
asks how many of a text's letter trigrams stand in the training windows, and compares that with what a training window
finds in the other ones.

Training rows: a non-missing label and id, a letter in the text, and crc32 of the id as text modulo 4 other than 2; of
each label the ``PER_LABEL`` documents with the lowest hash of id and text give up to ``SNIPPETS`` windows each.  Label,
source and id are never inputs of a prediction.

Edge cases: a missing text or one without a letter is ``und`` with score 0; without any training row every text is; a
missing id counts as not held out and is not learned from; ties go to the first language in sorted order; repeated rows
come back one by one; an empty table gives no rows; other columns are ignored, and kept by :func:`drop_unidentified`
whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window as W, functions as F

#: Bytes that the recurrence runs over, units in each direction, windows run at a time.
WINDOW, UNITS, ROWS = 128, 8, 2048
#: Training sample: documents of each label, windows of each document; training steps, however many windows there are.
PER_LABEL, SNIPPETS, STEPS = 400, 3, 190
#: Rows that the first cut at a hash leaves of a label on average, as a multiple of ``PER_LABEL``; growth of a cut too low.
SLACK, WIDER = 4, 16
#: Bytes of a training window, windows in a training step.
SPAN, STEP_ROWS = 64, 256
UNKNOWN = "und"
#: The pipeline rejects a document whose best mean probability lies less than this share of the way from chance to 1.
LEAST_MARGIN = 0.1
#: It also rejects one whose letters are less than this share as familiar as those of a training window usually are.
LEAST_FAMILIAR = 0.5
#: Trigrams that every text is taken to have besides its own, as familiar as usual: a few strange words reject nothing.
PRIOR_TRIGRAMS = 8
#: Bytes of a text whose trigrams are looked up at a time.
STRIP = 1 << 18

_LETTER = regex.compile(r"\p{L}")
#: Byte classes: 0 pads; ASCII letters and all bytes of other scripts count when probabilities are pooled.
_POOLED = np.array([97 <= (c | 32) <= 122 or c >= 128 for c in range(256)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Direction:
    """One gated recurrent layer: input rows by byte (update, reset, candidate), recurrent weights for the same."""

    table: np.ndarray
    gates: np.ndarray
    candidate: np.ndarray

    def run(self, codes: np.ndarray) -> tuple[np.ndarray, list]:
        """States after each of the (steps, rows) bytes, and what the backward pass needs."""
        units = self.candidate.shape[0]
        state = np.zeros((codes.shape[1], units), np.float32)
        states = np.empty((*codes.shape, units), np.float32)
        kept = []
        for t, code in enumerate(codes):
            given = self.table[code]
            both = _sigmoid(given[:, : 2 * units] + state @ self.gates)
            update, reset = both[:, :units], both[:, units:]
            lowered = reset * state
            new = np.tanh(given[:, 2 * units :] + lowered @ self.candidate)
            kept.append((state, both, lowered, new))
            state = state + update * (new - state)
            states[t] = state
        return states, kept

    def states(self, codes: np.ndarray) -> np.ndarray:
        """The same states as (steps, units, rows), without what only training needs."""
        units = self.candidate.shape[0]
        # sigmoid(x) is tanh(x / 2) / 2 + 1 / 2; rows lie last, so every slice is contiguous
        table = self.table.T.copy()
        table[: 2 * units] *= 0.5
        gates, candidate = self.gates.T * np.float32(0.5), self.candidate.T.copy()
        state = np.zeros((units, codes.shape[1]), np.float32)
        states = np.empty((len(codes), *state.shape), np.float32)
        given = np.empty((3 * units, codes.shape[1]), np.float32)
        both, new = given[: 2 * units], given[2 * units :]
        update, reset = both[:units], both[units:]
        for t, code in enumerate(codes):
            np.take(table, code, axis=1, out=given, mode="clip")
            both += gates @ state
            np.tanh(both, out=both)
            both *= 0.5
            both += 0.5
            reset *= state
            new += candidate @ reset
            np.tanh(new, out=new)
            new -= state
            new *= update
            state = np.add(state, new, out=states[t])
        return states

    def gradients(self, codes: np.ndarray, kept: list, wanted: np.ndarray) -> list[np.ndarray]:
        """Backpropagation through time of the loss's gradient with respect to every state."""
        units = self.candidate.shape[0]
        d_table, d_gates, d_candidate = (np.zeros_like(w) for w in (self.table, self.gates, self.candidate))
        carried = np.zeros_like(wanted[0])
        for t in range(len(codes) - 1, -1, -1):
            state, both, lowered, new = kept[t]
            update, reset = both[:, :units], both[:, units:]
            d_state = wanted[t] + carried
            d_new = d_state * update * (1 - new * new)
            d_lowered = d_new @ self.candidate.T
            d_both = np.concatenate([d_state * (new - state), d_lowered * state], axis=1) * both * (1 - both)
            d_candidate += lowered.T @ d_new
            d_gates += state.T @ d_both
            np.add.at(d_table, codes[t], np.concatenate([d_both, d_new], axis=1))
            carried = d_state * (1 - update) + d_lowered * reset + d_both @ self.gates.T
        return [d_table, d_gates, d_candidate]


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray
    bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [w for d in (self.forward, self.backward) for w in (d.table, d.gates, d.candidate)] + [self.out, self.bias]

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """Probabilities of the languages at each of the (steps, rows) bytes, as (steps, languages, rows)."""
        units = self.forward.candidate.shape[0]
        out = self.out.T.copy()
        given = out[:, :units] @ self.forward.states(codes)
        given += out[:, units:] @ self.backward.states(codes[::-1])[::-1]
        given += self.bias[:, None]
        given -= given.max(axis=1, keepdims=True)
        np.exp(given, out=given)
        given /= given.sum(axis=1, keepdims=True)
        return given


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def train(samples: Sequence[tuple[bytes, str]], units: int = UNITS, steps: int = STEPS, seed: int = 7) -> Network | None:
    """Fit the network to (window, language) pairs with Adam; None without samples."""
    languages = sorted({lang for _, lang in samples})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    real = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
    one = lambda: Direction(real(256, 3 * units), real(units, 2 * units), real(units, units))
    net = Network(languages, one(), one(), real(2 * units, len(languages)), np.zeros(len(languages), np.float32))
    order = sorted(samples)  # independent of the order in which rows arrived
    codes = np.zeros((SPAN, len(order)), np.uint8)
    for i, (window, _) in enumerate(order):
        codes[: len(window[:SPAN]), i] = np.frombuffer(window[:SPAN], np.uint8)
    target = np.array([languages.index(lang) for _, lang in order])
    share = np.bincount(target) * len(languages)
    weight = (len(order) / share)[target].astype(np.float32)
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in net.weights()]
    mixed = np.empty(0, int)
    for step in range(1, steps + 1):
        if len(mixed) < STEP_ROWS:
            mixed = np.concatenate([mixed, rng.permutation(np.resize(np.arange(len(order)), max(len(order), STEP_ROWS)))])
        pick, mixed = mixed[:STEP_ROWS], mixed[STEP_ROWS:]
        found = _loss_gradients(net, codes[:, pick], target[pick], weight[pick])
        rate = 0.02 * 0.5 * (1 + np.cos(np.pi * step / steps))
        for w, g, m in zip(net.weights(), found, moments, strict=True):
            m[0] += 0.1 * (g - m[0])
            m[1] += 0.01 * (g * g - m[1])
            w -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
    return net


def _loss_gradients(net: Network, codes: np.ndarray, target: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross-entropy over pooled positions, in the order of ``weights``."""
    units = net.forward.candidate.shape[0]
    ahead, kept_ahead = net.forward.run(codes)
    back, kept_back = net.backward.run(codes[::-1])
    states = np.concatenate([ahead, back[::-1]], axis=2)
    error = _softmax(states @ net.out + net.bias)
    error[:, np.arange(len(target)), target] -= 1
    use = _POOLED[codes].astype(np.float32) * weight
    error *= (use / max(use.sum(), 1))[:, :, None]
    d_out = np.einsum("tri,trj->ij", states, error)
    d_states = error @ net.out.T
    return [
        *net.forward.gradients(codes, kept_ahead, d_states[:, :, :units]),
        *net.backward.gradients(codes[::-1], kept_back, d_states[::-1, :, units:]),
        d_out,
        error.sum(axis=(0, 1)),
    ]


def document_probabilities(net: Network, texts: Sequence[bytes]) -> np.ndarray:
    """Mean probabilities over the pooled positions of each whole text; zeros where there are none."""
    sizes = np.array([len(t) for t in texts], np.int64)
    count = -(-sizes // WINDOW)
    total = np.zeros((len(texts), len(net.languages)))
    pooled = np.zeros(len(texts))
    owner = np.repeat(np.arange(len(texts)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    for i in range(0, len(owner), ROWS):
        own = owner[i : i + ROWS]
        codes = np.zeros((WINDOW, len(own)), np.uint8)
        for r, (d, n) in enumerate(zip(own.tolist(), nth[i : i + ROWS].tolist(), strict=True)):
            part = texts[d][n * WINDOW : (n + 1) * WINDOW]
            codes[: len(part), r] = np.frombuffer(part, np.uint8)
        use = _POOLED[codes]
        given = net.positions(codes)
        given *= use[:, None, :]
        np.add.at(total, own, given.sum(axis=0).T)
        np.add.at(pooled, own, use.sum(axis=0))
    return total / np.maximum(pooled, 1)[:, None]


def letter_trigrams(text: bytes) -> Iterator[np.ndarray]:
    """Three neighbouring bytes of letters as one number, ASCII letters in lower case; strip by strip, repeats included."""
    for i in range(0, max(len(text) - 2, 0), STRIP):
        codes = np.frombuffer(text[i : i + STRIP + 2].lower(), np.uint8)
        letter = _POOLED[codes]
        wide = codes.astype(np.int32)
        whole = letter[:-2] & letter[1:-1] & letter[2:]
        yield ((wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:])[whole]


@dataclass
class Familiar:
    """The letter trigrams of the training windows, and the share of a window's trigrams that another window has too."""

    known: np.ndarray
    usual: float

    def table(self) -> np.ndarray:
        found = np.zeros(1 << 24, bool)
        found[self.known] = True
        return found

    def share(self, text: bytes, table: np.ndarray, distinct: bool = False) -> float:
        """Share of known trigrams in a whole text, ``PRIOR_TRIGRAMS`` of usual familiarity added; each counts once if ``distinct``."""
        parts = letter_trigrams(text)
        if distinct:
            whole = np.empty(0, np.int32)
            for part in parts:
                whole = np.union1d(whole, part)
            parts = iter([whole])
        seen, size = PRIOR_TRIGRAMS * self.usual, PRIOR_TRIGRAMS
        for found in parts:
            seen += int(np.count_nonzero(table[found]))
            size += len(found)
        return seen / size

    def strange(self, text: bytes, table: np.ndarray, least: float) -> bool:
        """Less than ``least`` as familiar as usual by all trigrams and by distinct ones.

        All count, so that some noise in a long text rejects nothing; distinct ones, so that one strange word often repeated
        doesn't either.
        """
        low = least * self.usual
        return self.share(text, table) < low and self.share(text, table, distinct=True) < low


def familiar(samples: Sequence[tuple[bytes, str]]) -> Familiar:
    """What the training windows of all languages have in common with one another; equal windows count once."""
    windows = [np.concatenate([*letter_trigrams(w), np.empty(0, np.int32)]) for w in sorted({w for w, _ in samples})]
    within = [np.unique(w) for w in windows]
    known, held = np.unique(np.concatenate([*within, np.empty(0, np.int32)]), return_counts=True)
    shared = known[held > 1]
    shares = [np.isin(w, shared).mean() for w in windows if len(w)]
    return Familiar(known, float(np.median(shares)) if shares else 0.0)


def training_sample(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> list[tuple[bytes, str]]:
    """Windows of labelled documents, at most ``PER_LABEL * SNIPPETS`` for each label."""
    rest = F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4))
    usable = docs.where(F.col(label).isNotNull() & (rest != 2) & F.col(text).rlike(r"\p{L}"))
    # the windows are cut out before rows are compared and shuffled
    size = F.length(text)
    starts = [F.floor(size * (2 * i + 1) / (2 * SNIPPETS)) - SPAN // 2 for i in range(SNIPPETS)]
    cut = F.array(*[F.substring(F.col(text), F.greatest(s + 1, F.lit(1)).cast("int"), F.lit(SPAN)) for s in starts])
    chosen = usable.select(F.col(label).cast("string").alias("label"), F.xxhash64(key, text).alias("h"), F.array_distinct(cut).alias("w"))
    told = docs.where(F.col(label).isNotNull() & (rest != 2)).groupBy(F.col(label).cast("string").alias("label")).count()
    shares = {r["label"]: SLACK * PER_LABEL / r["count"] for r in told.collect()}
    out: list[tuple[bytes, str]] = []
    while shares:
        rows = _lowest(chosen, shares).collect()
        got = Counter(r["label"] for r in rows)
        # a cut that leaves too few rows although others are above it is made again, higher
        short = {k for k, share in shares.items() if got[k] < PER_LABEL and share < 1}
        out += [(w.encode(), r["label"]) for r in rows if r["label"] not in short for w in r["w"]]
        shares = {k: share * WIDER for k, share in shares.items() if k in short}
    return out


def _lowest(chosen: DataFrame, shares: dict[str, float]) -> DataFrame:
    """The ``PER_LABEL`` rows of each label with the lowest hashes, among those in the given share of all hashes.

    Cut before they are ranked, no label's rows fill a task; of equal rows a task hands on ``PER_LABEL`` at most.
    """
    highest = {k: -(1 << 63) + min(int(share * (1 << 64)), (1 << 64) - 1) for k, share in shares.items()}
    cut = F.create_map(*[F.lit(v) for pair in highest.items() for v in pair])
    low = W.partitionBy("label").orderBy("h", "w")
    few = chosen.where(F.col("h") <= cut[F.col("label")])
    return few.withColumn("n", F.row_number().over(low)).where(F.col("n") <= PER_LABEL).select("label", "w")


def predict(docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``doc_id, text_hash, lang_pred, score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            plain = [t is not None and _LETTER.search(t) is not None for t in texts]
            known = np.array(plain, bool) & (net is not None)
            names = np.full(len(texts), UNKNOWN, object)
            scores = np.zeros(len(texts))
            if known.any():
                own = document_probabilities(net, [t.encode() for t, k in zip(texts, known, strict=True) if k])
                names[known] = np.array(net.languages, object)[own.argmax(axis=1)]
                scores[known] = np.clip(own.max(axis=1), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names.tolist(), pa.string()), pa.array(scores)],
                ["doc_id", "text_hash", "lang_pred", "score"],
            )

    keyed = docs.select(F.col(key).cast("long"), F.xxhash64(text), F.col(text))
    return keyed.mapInArrow(run, "doc_id long, text_hash long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Held-out mark, language and score per document of a table with doc_id, text and lang."""
    net = train(training_sample(docs))
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    return predict(docs, net).select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def drop_unidentified(
    docs: DataFrame, text: str = "text", margin: float = LEAST_MARGIN, least: float = LEAST_FAMILIAR
) -> DataFrame:
    """The documents in one of the learned languages, with all their columns.

    Kept is a text with a letter, a best score of at least ``margin`` of the way from chance to 1, and letters that are at
    least ``least`` as familiar as those of a training window (:meth:`Familiar.strange`).
    """
    sample = training_sample(docs)
    net, seen = train(sample), familiar(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = seen.table()
        for batch in batches:
            texts = batch.column(0).field(at).to_pylist()
            keep = np.zeros(len(texts), bool)
            known = [i for i, t in enumerate(texts) if net is not None and t is not None and _LETTER.search(t)]
            if known:
                own = [texts[i].encode() for i in known]
                chance = 1 / len(net.languages)
                sure = document_probabilities(net, own).max(axis=1) >= chance + margin * (1 - chance) - 1e-6
                keep[known] = sure & ~np.array([seen.strange(t, table, least) for t in own])
            yield batch.filter(pa.array(keep))

    at = docs.columns.index(text)
    # a row is one struct, so any column name passes
    packed = docs.select(F.struct("*").alias("row"))
    return packed.mapInArrow(run, packed.schema).select("row.*")
