"""Toxic documents by a linear-chain conditional random field over their words.

Labels are given for documents. A word of a toxic document is labelled toxic when one of its forms (the
word, or its first three to six letters) is found almost only in toxic documents of the training sample,
and in enough of them; copies in the sample count once. Toxic documents without such a word teach the
field nothing. On these labels a two-state field is fitted: a weight per hashed form, a weight per pair
of neighbouring tags. Forward and backward passes give each word's probability of being toxic. A
document's score is a logistic function of their maximum and of their sum over the words that are more
likely toxic than not, fitted on the same sample; its spans are the runs of such words.

Long texts are tagged in chains of ``CHAIN`` words that follow each other without gaps, so every word
counts; all chains of a batch advance together as one array.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import map_texts, text_or_empty, unused

CHAIN = 64
STRIPPED = ".,;:!?\"'()[]{}<>*#-_"
MAX_WORDS = 250_000
THRESHOLD = 0.3
#: Characters tagged at once.
SCORED = 1_000_000


def forms(word: str) -> list[str]:
    """The word in lower case without marks around it, and its beginnings."""
    bare = word.strip(STRIPPED).lower()
    return ["=" + bare] + [f"{k}^{bare[:k]}" for k in (3, 4, 5, 6) if len(bare) >= k]


def hashes(word: str) -> list[int]:
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) for f in forms(word)]


def chains(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the chains of consecutive texts of ``lengths`` words."""
    counts = -(-lengths // CHAIN)
    first = np.repeat(np.cumsum(lengths) - lengths, counts)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = first + number * CHAIN
    return starts, np.minimum(CHAIN, np.repeat(lengths, counts) - number * CHAIN)


def marginals(emission: np.ndarray, transition: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of the toxic tag at each word, and the expected counts of tag pairs.

    ``emission`` is the score of toxic over clean; ``transition[a, b]`` the score of tag b after tag a.
    """
    n = len(starts)
    probability = np.zeros(len(emission))
    pairs = np.zeros((2, 2))
    if not n:
        return probability, pairs
    steps = np.arange(int(sizes.max()))
    inside = steps[None, :] < sizes[:, None]
    index = np.where(inside, starts[:, None] + steps, 0)
    toxic = np.exp(np.clip(emission, -30, 30))[index]
    move = np.exp(transition)
    forward = np.empty((len(steps), 2, n))
    now = np.stack([np.full(n, 1.0), toxic[:, 0]])
    forward[0] = now / now.sum(axis=0)
    for t in steps[1:]:
        now = move.T @ forward[t - 1]
        now[1] *= toxic[:, t]
        forward[t] = now / now.sum(axis=0)
    backward = np.ones((2, n))
    for t in steps[::-1]:
        both = forward[t] * backward
        here = both[1] / both.sum(axis=0)
        probability[index[inside[:, t], t]] = here[inside[:, t]]
        if t == 0:
            break
        # words beyond the end of a chain leave its backward message at one
        message = backward.copy()
        message[1] *= toxic[:, t]
        joint = forward[t - 1][:, None, :] * move[:, :, None] * message[None, :, :]
        live = inside[:, t]
        pairs += (joint / joint.sum(axis=(0, 1)))[:, :, live].sum(axis=2)
        back = move @ message
        backward = np.where(live, back / back.sum(axis=0), 1.0)
    return probability, pairs


@dataclass
class Model:
    """Weights of hashed forms, of every word, of tag pairs and of the document score; ``key`` names it."""

    weights: dict[int, float]
    bias: float
    transition: np.ndarray
    score: np.ndarray
    key: str = ""

    def __post_init__(self) -> None:
        told = repr((sorted(self.weights.items()), self.bias, self.transition.tolist(), self.score.tolist()))
        self.key = hashlib.sha256(told.encode()).hexdigest()


def constant(score: float) -> Model:
    """A model that gives every text the same score, 0 or 1."""
    return Model({}, 0.0, np.zeros((2, 2)), np.array([np.inf if score else -np.inf, 0.0, 0.0]))


def _sums(probability: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log(1 + sum of those of one half or more) and maximum of the probabilities of each text.

    Words below one half add nothing, so a text is not toxic by its mere length.
    """
    total = np.concatenate([[0.0], np.cumsum(np.where(probability >= 0.5, probability, 0.0))])
    ends = np.cumsum(lengths)
    sums = total[ends] - total[ends - lengths]
    top = np.zeros(len(lengths))
    full = np.flatnonzero(lengths)
    if len(full):
        top[full] = np.maximum.reduceat(probability, (ends - lengths)[full])
    return np.stack([np.log1p(np.maximum(sums, 0)), top])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def distinct_texts(texts: list[str]) -> list[int]:
    """Indices of texts that are no near copies of earlier ones: none of four minima over five-word runs is shared."""
    kept, seen = [], set()
    for i, text in enumerate(texts):
        words = text.split()
        hashes = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)
        runs = np.zeros(max(1, len(words) - 4), np.uint64)
        for k in range(min(5, len(words))):
            runs = runs * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(runs)]
        minima = {(k, int(((runs ^ np.uint64(k * 0x632BE59BD9B4E019 & (2**64 - 1))) * np.uint64(0xD6E8FEB86659FD93)).min())) for k in range(1, 5)}
        if not minima & seen:
            kept.append(i)
            seen |= minima
    return kept


def fit(texts: list[str], toxic: list[int], odds: float | None = None, rounds: int = 35, least: float = 0.03, share: float = 0.95) -> Model:
    """Fit on labelled texts. Without a toxic text, every score is 0; without a clean one, every score is 1.

    A form marks toxic words if ``share`` of its texts are toxic (both classes counted as of equal size)
    and it is in ``least`` of the toxic ones, three at least. Toxic texts that no such form explains are
    looked at once more by themselves, where a form must be in a fifth of them. ``odds`` are those of toxic
    to clean among all labelled texts, where the sample has others.
    """
    if not any(toxic) or all(toxic):
        return constant(float(any(toxic)))
    chosen = distinct_texts(texts)
    texts, label = [texts[i] for i in chosen], np.array([toxic[i] for i in chosen], bool)
    if label.all() or not label.any():
        texts, label = list(texts), np.array(toxic, bool)
    words: dict[str, int] = {}
    rows = [np.array([words.setdefault(w, len(words)) for w in t.split()], np.int64) for t in texts]
    lengths = np.array([len(r) for r in rows])
    tokens = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    if not len(tokens):
        return constant(0.0)
    table = np.full((len(words), 5), 1 << 32, np.int64)
    for word, at in words.items():
        own = hashes(word)
        table[at, : len(own)] = own
    names, table = np.unique(np.append(table, 1 << 32), return_inverse=True)
    table, size = table[:-1].reshape(len(words), 5), len(names)
    # in how many toxic and clean texts each form occurs
    owner = np.repeat(np.arange(len(rows)), lengths)
    seen = np.unique(owner * len(words) + tokens)
    pairs = np.unique((seen // len(words))[:, None] * size + table[seen % len(words)])
    form, text_of = pairs % size, pairs // size
    bad = np.bincount(form[label[text_of]], minlength=size)
    good = np.bincount(form[~label[text_of]], minlength=size)
    even = good * (label.sum() / max(1, (~label).sum()))
    tells = bad >= share * (bad + even)
    telling = tells & (bad >= max(3, least * label.sum()))
    telling[-1] = False
    rest = label & ~(np.bincount(text_of, weights=telling[form], minlength=len(rows)) > 0)
    again = np.bincount(form[rest[text_of]], minlength=size)
    telling |= tells & (again >= max(5, 0.2 * rest.sum()))
    common = bad + good >= 3
    telling[-1] = common[-1] = False
    tags = telling[table].any(axis=1)[tokens] & label[owner]
    # forms too rare to learn from weigh nothing, texts that teach nothing are left out
    table = np.where(common[table], table, size - 1)
    taught = ~label | (np.bincount(owner, weights=tags, minlength=len(rows)) > 0)
    tokens, tags = tokens[taught[owner]], tags[taught[owner]]
    lengths, label = lengths[taught], label[taught]
    if not label.any():
        return constant(0.0)

    starts, sizes = chains(lengths)
    follows = np.ones(len(tokens), bool)
    follows[starts] = False
    tag = tags.astype(int)
    told = np.zeros((2, 2))
    np.add.at(told, (tag[np.flatnonzero(follows) - 1], tag[follows]), 1)
    weights, transition = np.zeros(size), np.zeros((2, 2))
    bias, square_w, square_t, square_b = -3.0, np.full(size, 1e-8), np.full((2, 2), 1e-8), 1e-8
    scale = 1.0 / len(lengths)
    for _ in range(rounds):
        by_word = weights[table].sum(axis=1) + bias
        probability, expected = marginals(by_word[tokens], transition, starts, sizes)
        residual = np.bincount(tokens, weights=tags - probability, minlength=len(words)) * scale
        slope = np.bincount(table.ravel(), weights=np.repeat(residual, table.shape[1]), minlength=len(weights)) - 1e-5 * weights
        slope[-1] = 0
        square_w += slope**2
        weights += 1.0 * slope / np.sqrt(square_w)
        step = (told - expected) * scale
        square_t += step**2
        transition += 0.4 * step / np.sqrt(square_t)
        step = float(residual.sum())
        square_b += step**2
        bias += 1.0 * step / np.sqrt(square_b)
    by_word = weights[table].sum(axis=1) + bias
    probability, _ = marginals(by_word[tokens], transition, starts, sizes)
    x = np.concatenate([np.ones((1, len(lengths))), _sums(probability, lengths)])
    score = np.zeros(3)
    for _ in range(25):  # Newton steps of a ridge-penalised logistic fit
        p = _logistic(score @ x)
        hessian = (x * (p * (1 - p))) @ x.T + np.diag([1e-3, 0.1, 0.1])
        score += np.linalg.solve(hessian, x @ (label - p) - np.array([0.0, 0.1, 0.1]) * score)
    if odds is not None:
        score[0] += np.log(odds) - np.log(label.sum() / max(1, (~label).sum()))
    told = np.flatnonzero(weights)
    return Model(dict(zip(names[told].tolist(), weights[told].tolist())), bias, transition, score)


class Tagger:
    """Applies a model to texts; scores of seen words are kept."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.words: dict[str, float] = {}

    def tag(self, texts: list[str]) -> tuple[list[float], list[list[dict]]]:
        """Score and toxic spans of each text."""
        tokens = [t.split() for t in texts]
        if not np.isfinite(self.model.score[0]):
            return [1.0 if self.model.score[0] > 0 else 0.0] * len(texts), [[] for _ in texts]
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        known, weight, bias = self.words, self.model.weights.get, self.model.bias
        for word in set().union(*tokens):
            if word not in known:
                known[word] = bias + sum(weight(h, 0.0) for h in hashes(word))
        lengths = np.array([len(t) for t in tokens], np.int64)
        emission = np.fromiter((known[w] for t in tokens for w in t), np.float64, int(lengths.sum()))
        probability, _ = marginals(emission, self.model.transition, *chains(lengths))
        scores = _logistic(self.model.score[0] + self.model.score[1:] @ _sums(probability, lengths))
        spans: list[list[dict]] = [[] for _ in texts]
        hits = np.flatnonzero(probability >= 0.5)
        ends = np.cumsum(lengths)
        rows = np.searchsorted(ends, hits, side="right")
        for row in np.unique(rows).tolist():
            wanted = hits[rows == row] - (ends[row] - lengths[row])
            places = [m.span() for m in re.finditer(r"\S+", texts[row])]
            runs = np.split(wanted, np.flatnonzero(np.diff(wanted) > 1) + 1)
            spans[row] = [{"start": places[r[0]][0], "end": places[r[-1]][1]} for r in runs]
        return scores.tolist(), spans


_TAGGERS: dict[str, Tagger] = {}


def tagger(model: Model) -> Tagger:
    if model.key not in _TAGGERS:
        _TAGGERS.clear()
        _TAGGERS[model.key] = Tagger(model)
    return _TAGGERS[model.key]


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, rows: int) -> tuple[list[str], list[int], float | None]:
    """Up to ``rows`` labelled texts of each class that are not held out, chosen by a hash of their id, and
    the odds of toxic to clean among all such texts.

    This is the only bound: each chosen text is whole, as it is scored.
    """
    told = labels.where(F.col(label).isin(0, 1) & ~held_out(doc_id) & F.col(doc_id).isNotNull())
    told = told.groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
    body = docs.select(F.col(f"`{doc_id}`").alias("_id"), text_or_empty(text).alias("_body"))
    present = told.join(docs.select(F.col(f"`{doc_id}`").alias("_id")).distinct(), "_id", "left_semi")
    counts = dict(present.groupBy("_label").count().collect())
    chosen: list[tuple] = []
    for value in (0, 1):
        order = present.where(F.col("_label") == value).orderBy(F.xxhash64(F.col("_id").cast("string")), "_id").limit(rows)
        chosen += [(r[0], value) for r in order.select("_id").collect()]
    if not chosen:
        return [], [], None
    ids = docs.sparkSession.createDataFrame(chosen, f"_id {dict(body.dtypes)['_id']}, _label int")
    # of rows with equal ids, the least text
    found = body.join(F.broadcast(ids), "_id").groupBy("_id", "_label").agg(F.min("_body").alias("_body")).orderBy("_id").collect()
    odds = counts[1] / counts[0] if len(counts) == 2 else None
    return [r["_body"] for r in found], [r["_label"] for r in found], odds


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = 1200) -> Model:
    """A model fitted on a bounded sample of the labelled documents that are not held out."""
    return fit(*training_sample(docs, labels, doc_id, text, label, sample_rows))


def score_documents(docs: DataFrame, model: Model, text: str = "text", score: str = "score", spans: str | None = "spans") -> DataFrame:
    """All rows and columns, with the score of the text and its toxic spans (code points, end exclusive).

    Defined results: a null text is scored as the empty one and has no spans; columns of those names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    made = [score] + ([spans] if spans else [])
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def work(texts: list[str]) -> dict:
        scores, found = tagger(sent.value).tag(texts)
        return {score: pa.array(scores, pa.float64())} | ({spans: pa.array(found, span_type)} if spans else {})

    rows = docs.select(*[F.col(f"`{c}`").cast("string").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c not in made])
    schema = f"`{score}` double" + (f", `{spans}` array<struct<start:int,end:int>>" if spans else "")
    return map_texts(rows, work, schema, text=text, keep=True, limit=SCORED)


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores below the threshold, with their own columns."""
    score = unused(docs, "_toxic_score")
    scored = score_documents(docs, model, text, score=score, spans=None)
    return scored.where(F.col(score) < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
