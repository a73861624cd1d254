"""Language identification by multilingual mixture inference.

Training counts character trigrams per language over all labelled documents, in hash
buckets; each task sums its own counts first, so at most languages x buckets numbers per
task are shuffled. A document is seen as a mixture of languages: expectation-maximisation
estimates the proportions from the trigram likelihoods. The set of languages grows from
the best single one, by the language that promises the largest gain, as long as the
penalised likelihood improves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, pick, pieces, shown_id

BITS = 16
BUCKETS = 1 << BITS
#: Bound on the model that is broadcast: this many languages, of BUCKETS numbers each.
MAX_LANGUAGES = 256
SMOOTHING = 0.5
#: Log-likelihood a further language must win per log of the trigrams (a BIC with weight 2).
PENALTY = 2.0
#: Trigrams overlap, so each one counts as a third of an independent observation.
OVERLAP = 3.0
STEPS, TOLERANCE = 30, 1e-4
UNDETERMINED = "und"


class Model(NamedTuple):
    """Languages in order of name, log-likelihood by language and bucket, and log priors."""

    languages: list[str]
    log_p: np.ndarray
    log_prior: np.ndarray


def learnable(c: Column) -> Column:
    """Whether a document of this id may be learned from; a null id never is."""
    return F.coalesce(F.crc32(c.cast("string")) % 4 != 2, F.lit(False))


@lru_cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    low = np.full(0x110000, 32, np.uint32)
    letter = np.zeros(0x110000, bool)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            letter[i], low[i] = True, ord(c.lower()[0])
    return low, letter


def trigrams(text: str) -> np.ndarray:
    """Buckets of the trigrams of letters and borders; empty if the text has no letter."""
    low, letter = _tables()
    raw = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if not letter[raw].any():
        return np.zeros(0, np.int64)
    c = np.concatenate([[32], low[raw], [32]]).astype(np.uint32)
    keep = c[1:-1] != 32  # the letter in the middle; everything but letters is a border
    h = c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA77) + c[2:] * np.uint32(0xC2B2AE3D)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h[keep] >> np.uint32(32 - BITS)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for b in pieces(batches):
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if lang not in sums:
                sums[lang], docs[lang] = np.zeros(BUCKETS, np.int64), 0
            g = trigrams(text)
            np.add(sums[lang], np.bincount(g, minlength=BUCKETS), out=sums[lang]) if len(g) > 4096 else np.add.at(sums[lang], g, 1)
            docs[lang] += 1
    for lang, total in sums.items():
        at = np.flatnonzero(total)
        buckets = np.append(at, -1)  # -1: the number of documents
        counts = np.append(total[at], docs[lang])
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(buckets), pa.string()), pa.array(buckets), pa.array(counts)], ["lang", "bucket", "n"]
        )


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trigram model from every document that may be learned from and has a language.

    Null texts count as empty. Without any such document the model has no language.
    """
    rows = pick(docs, id=id_col, text=text_col, lang=lang_col).where(learnable(F.col("id")) & F.col("lang").isNotNull())
    counts = (
        rows.select(F.col("lang").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
        .mapInArrow(_counted, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    # One packed row per language: bounded by BUCKETS, and by MAX_LANGUAGES rows.
    packed = counts.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n"))
    found = packed.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    found.sort(key=lambda r: r["lang"])
    log_p, prior = np.zeros((len(found), BUCKETS)), np.zeros(len(found))
    for row, r in enumerate(found):
        b, n = np.array(r["b"]), np.array(r["n"], np.float64)
        prior[row] = n[b == -1].sum()
        full = np.full(BUCKETS, SMOOTHING)
        full[b[b >= 0]] += n[b >= 0]
        log_p[row] = np.log(full / full.sum())
    return Model([r["lang"] for r in found], log_p.astype(np.float32), np.log(prior / max(prior.sum(), 1)))


def mixture(p: np.ndarray, n: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood of the languages in the rows of ``p``, by EM."""
    share, before = start, -np.inf
    for _ in range(STEPS):
        mix = share @ p
        now = float(n @ np.log(mix))
        share = share * (p @ (n / mix)) / n.sum()
        if now - before < TOLERANCE * max(1.0, abs(now) * 1e-3):
            break
        before = now
    return share, float(n @ np.log(share @ p))


def proportions(grams: np.ndarray, model: Model) -> np.ndarray:
    """Share of each language in a document; the chosen set has positive shares."""
    at, n = np.unique(grams, return_counts=True)
    n = n / OVERLAP
    log_p = model.log_p[:, at].astype(np.float64)
    p = np.exp(log_p - log_p.max(0))  # scaled per trigram: proportions do not change
    single = np.log(p) @ n
    first = int(np.argmax(single + model.log_prior))
    chosen, share, best = [first], np.ones(1), float(single[first])
    cost = PENALTY * np.log(max(n.sum(), np.e))
    while len(chosen) < len(p):
        gain = p @ (n / (share @ p[chosen])) - n.sum()
        gain[chosen] = -np.inf
        more = int(np.argmax(gain))
        if gain[more] <= 0:
            break
        new, value = mixture(p[[*chosen, more]], n, np.append(share * 0.9, 0.1))
        if value - best <= cost:
            break
        chosen, share, best = [*chosen, more], new, value
    # A language that stood in for others goes again once they are there.
    while len(chosen) > 1:
        kept = [[k for k in chosen if k != c] for c in chosen]
        fits = [mixture(p[k], n, np.full(len(k), 1 / len(k))) for k in kept]
        least = int(np.argmax([value for _, value in fits]))
        if best - fits[least][1] > cost:
            break
        chosen, (share, best) = kept[least], fits[least]
    out = np.zeros(len(p))
    out[chosen] = share
    return out


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, lang_pred, score, mixture), one row per input row.

    ``mixture`` maps each language of the chosen set to its proportion; ``lang_pred`` is the
    largest (ties: first by name) and ``score`` its proportion. A null text or a text
    without a letter is ``und`` with score 0 and an empty mixture, as is every text if
    nothing was learned. Repeated rows have equal results; a null id stays null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in pieces(batches):
            names, scores, maps = [], [], []
            for text in b.column(2).to_pylist():
                g = trigrams(text)
                share = proportions(g, m) if len(g) and m.languages else np.zeros(1)
                best = int(np.argmax(share))
                names.append(m.languages[best] if share[best] > 0 else UNDETERMINED)
                scores.append(min(1.0, float(share[best])))
                maps.append([(m.languages[i], float(share[i])) for i in np.flatnonzero(share)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(names), pa.array(scores), pa.array(maps, pa.map_(pa.string(), pa.float64()))],
                ["id", "text_key", "lang_pred", "score", "mixture"],
            )

    out = documents(docs, id_col, text_col).mapInArrow(
        predicted, "id long, text_key long, lang_pred string, score double, mixture map<string,double>"
    )
    return out.select(shown_id().alias("doc_id"), "text_key", "lang_pred", "score", "mixture")
