"""Language identification with error-correcting output codes.

Every language has a codeword of bits.  For each bit a linear classifier over hashed
character n-grams predicts whether a text's language has it; the losses of a text against
every codeword, weighted by how well each bit was learned, choose the nearest one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import pieces

#: Bits of the n-gram hash; the classifiers have two to this power weights each.
FEATURE_BITS = 12
#: The classifiers are fitted on about so many documents of each language, chosen by hash.
SAMPLE_PER_LANGUAGE = 250
#: A decision whose score is below this is flagged as ambiguous.
AMBIGUOUS = 0.6
UNKNOWN = "und"
_PART = 1 << 20
_FOLDS, _STEPS, _RATE, _DECAY = 5, 80, 0.5, 1e-5


def held_out(doc_id: Column) -> Column:
    """Whether the crc32 of the id as text is divisible by five; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % _FOLDS == 0, F.lit(False))


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n rows of +1 and -1: all distinct splits for up to seven languages, beyond that
    random columns, of which the draw with the largest least distance is taken."""
    if n <= 2:
        return np.array([[1.0], [-1.0]])[:n]
    if n <= 7:
        splits = np.arange(1 << (n - 1), (1 << n) - 1)
        return np.where(splits[None, :] >> np.arange(n)[:, None] & 1, 1.0, -1.0)
    rng, best, most = np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (n, int(np.ceil(15 * np.log2(n)))))
        apart = (code[:, None, :] != code[None, :, :]).sum(2)[~np.eye(n, dtype=bool)].min()
        if apart > most:
            best, most = code, apart
    return best


def _parts(texts: list[str]) -> Iterator[list[tuple[int, bytes, int, int]]]:
    """(row, bytes, positions to count, bytes to the end of the text), some MB at a time; long
    texts are cut, with what the last n-grams of a part need."""
    some, held = [], 0
    for row, text in enumerate(texts):
        raw = f" {text.lower()} ".encode("utf-8", "replace")
        for at in range(0, len(raw), _PART):
            part = raw[at : at + _PART + 3]
            some.append((row, part, min(_PART, len(raw) - at), len(raw) - at))
            held += len(part)
            if held >= _PART:
                yield some
                some, held = [], 0
    if some:
        yield some


def grams(texts: list[str], bits: int = FEATURE_BITS) -> np.ndarray:
    """One row per text: square roots of the counts of its hashed 1-, 3- and 4-grams of
    UTF-8 bytes in lower case, at unit length.  Every byte of the text counts."""
    out = np.zeros(len(texts) << bits)
    for some in _parts(texts):
        rows, raw, counted, left = zip(*some, strict=True)
        sizes = np.array([len(x) for x in raw])
        data = np.frombuffer(b"".join(raw) + bytes(3), np.uint8).astype(np.uint32)
        n = len(data) - 3
        inside = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        owner = np.repeat(np.array(rows, np.int64) << bits, sizes)
        rest = np.repeat(np.array(left), sizes) - inside
        here = inside < np.repeat(np.array(counted), sizes)
        key = np.zeros(n, np.uint32)
        for k in range(1, 5):
            key = (key << np.uint32(8)) | data[k - 1 : k - 1 + n]
            if k == 2:
                continue
            mixed = (key * np.uint32(2654435761) + np.uint32(k * 40503)) * np.uint32(2246822519)
            slot = owner + (mixed >> np.uint32(32 - bits)).astype(np.int64)
            out += np.bincount(slot[here & (rest >= k)], minlength=len(out))
    out = np.sqrt(out).reshape(len(texts), 1 << bits).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of ``grams`` the index of the language, and its share of all."""
        margins = rows @ self.weights + self.bias
        losses = (np.logaddexp(0, -margins[:, None, :] * self.code) * self.trust).sum(2)
        best = losses.argmin(1)
        share = np.exp(losses.min(1, keepdims=True) - losses)
        return best, 1.0 / share.sum(1)


def fit_rows(texts: list[str], languages: list[str], bits: int = FEATURE_BITS) -> Model:
    """Logistic regression for each code bit; its trust is how often it is right."""
    names = sorted(set(languages))
    code = codewords(len(names))
    x = np.concatenate([grams(texts[i : i + 64], bits) for i in range(0, len(texts), 64)])
    y = code[[names.index(v) for v in languages]]
    weights, bias = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    share = 1.0 / np.bincount([names.index(v) for v in languages], minlength=len(names))[[names.index(v) for v in languages]]
    share = (share / share.sum()).astype(np.float32)[:, None]
    for step in range(_STEPS):
        pull = share * y / (1 + np.exp(np.clip(y * (x @ weights + bias), -30, 30)))
        rate = _RATE * 100 / (1 + step / 100)
        weights += rate * (x.T @ pull - _DECAY * weights)
        bias += rate * 0.1 * pull.sum(0)
    right = (share * ((x @ weights + bias) * y > 0)).sum(0)
    return Model(names, code, weights.astype(np.float32), bias, np.maximum(right, 0.5).astype(np.float32))


def train(
    documents: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> Model | None:
    """Fit on labelled documents that are not held out.

    For each language the documents with the lowest hash of their id are taken, so many
    that about ``per_language`` are expected; at most twice that times the languages
    reach the driver.  None if nothing is labelled.
    """
    rows = documents.select(
        F.col(f"`{doc_id}`").alias("i"), F.col(f"`{text}`").cast("string").alias("t"), F.col(f"`{lang}`").cast("string").alias("l")
    ).filter(~held_out(F.col("i")) & F.col("l").isNotNull() & F.col("t").isNotNull())
    counts = {r.l: r.n for r in rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    part = F.pmod(F.xxhash64("i", F.lit("sample")), F.lit(1_000_000)) / 1e6
    share = F.create_map(*[F.lit(x) for l, n in counts.items() for x in (l, min(1.0, per_language / n))])
    sample = rows.filter(part < share[F.col("l")]).limit(2 * per_language * len(counts)).collect()
    sample.sort(key=lambda r: (r.l, r.i is not None, r.i, r.t))
    if len({r.l for r in sample}) < len(counts) and not sample:
        return None
    return fit_rows([r.t for r in sample], [r.l for r in sample])


def identify(documents: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` for every row.

    A null text, one without a letter, or no model at all give ``und`` with score 0.
    ``score`` is the chosen codeword's share among all, 0 to 1; below ``AMBIGUOUS`` the
    row is flagged.  Only the text is looked at, all of it.
    """
    rows = documents.select(
        F.col(f"`{doc_id}`").alias("doc_id"), held_out(F.col(f"`{doc_id}`")).alias("held_out"), F.col(f"`{text}`").cast("string").alias("t")
    )
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for piece in pieces(batch, "t", 1 << 20):
                texts = piece.column("t").to_pylist()
                named, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
                usable = [k for k, t in enumerate(texts) if t and known and any(map(str.isalpha, t))]
                for at in range(0, len(usable), 128):
                    some = usable[at : at + 128]
                    best, sure = known.decode(grams([texts[k] for k in some]))
                    for k, b, s in zip(some, best, sure, strict=True):
                        named[k], score[k] = known.languages[b], float(s)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("held_out"),
                        pa.array(named, pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array([s < AMBIGUOUS for s in score], pa.bool_()),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean")
