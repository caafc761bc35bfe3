"""Language identification with error-correcting output codes.

Every language gets a codeword; every bit of the codewords has a binary classifier over byte n-grams of ``GRAMS`` bytes
(runs of letters in lower case, one space between them), hashed into ``BUCKETS``. A classifier is the
log-odds of the n-grams' smoothed frequencies in the languages whose bit is 1 against those whose bit is 0, so all of them
come from one count per (language, bucket). A text's margin on a bit is the mean of its n-grams' weights.

Decoding is weighted by loss: the distance to a codeword is the sum over bits of the classifier's weight, learned from how
well its margins separate the training texts, times the logistic loss of the margin against the bit. The nearest codeword
wins; ``score`` is its share of exp(-distance), and a text is ``ambiguous`` if the runner-up is within ``AMBIGUITY``.

The classifiers are fitted on a bounded sample: of each language, the rows with the smallest hashes of their id, about
``SAMPLE_ROWS`` of them. Prediction reads every text once, whole, and shuffles nothing.

Defined results: a null text or one without a letter is ``und`` with score 0; without any training row every text is
``und``; with a single language that one is predicted with score 1; null languages are not learned; ties between codewords
go to the first language in order of name; repeated rows are predicted each by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from lintlake.llm.tokens import slices

UNKNOWN = "und"
GRAMS = (2, 3)
BUCKETS = 1 << 16
SAMPLE_ROWS = 3000
SMOOTHING = 0.5
#: Codes with all distinct splits of the languages up to so many; random ones of CODE_BITS bits beyond.
EXHAUSTIVE_LANGUAGES = 6
CODE_BITS = 48
#: Margins are means of weights over n-grams; the loss sees them times this.
SHARPNESS = 8.0
AMBIGUITY = 0.05


def codewords(n: int) -> np.ndarray:
    """One row of +1 and -1 per language; every column splits the languages in two."""
    if n < 2:
        return np.zeros((n, 0), dtype=np.int8)
    if n <= EXHAUSTIVE_LANGUAGES:
        splits = [[1, *[1 if split >> i & 1 else -1 for i in range(n - 1)]] for split in range(2 ** (n - 1) - 1)]
        return np.array(splits, dtype=np.int8).T
    best, far = None, -1
    for seed in range(50):  # of some random codes the one whose nearest codewords are farthest apart
        code = np.where(np.random.default_rng(seed).random((n, CODE_BITS)) < 0.5, -1, 1).astype(np.int8)
        code = code[:, np.abs(code.sum(axis=0)) < n]
        distance = (code[:, None, :] != code[None, :, :]).sum(axis=2) + np.eye(n, dtype=int) * CODE_BITS
        if distance.min() > far:
            best, far = code, distance.min()
    return best


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts' letters, text after text, and where each text's end. Null: none."""
    letters = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}\p{M}]+", " ")
    letters = pc.binary_join_element_wise(" ", pc.utf8_trim(letters, " "), " ", "")
    offsets = np.frombuffer(letters.buffers()[1], dtype=np.int32)[letters.offset : letters.offset + len(letters) + 1].astype(np.int64)
    data = np.frombuffer(letters.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    offsets = offsets - offsets[0]
    # An n-gram belongs to the byte it starts at; the texts' last bytes start none, so none crosses into the next text.
    usable = np.ones(len(data), dtype=bool)
    for i in range(1, max(GRAMS)):
        usable[np.maximum(offsets[1:] - i, offsets[:-1])] = False
    at = np.flatnonzero(usable)
    grams = np.empty((len(at), len(GRAMS)), dtype=np.int32)
    value, bucket = np.zeros(len(at), dtype=np.uint64), np.uint64(64 - BUCKETS.bit_length() + 1)
    for n in range(max(GRAMS)):
        value = (value << np.uint64(8)) | data[at + n]
        if n + 1 in GRAMS:
            hashed = (value + np.uint64((n + 1) << 56)) * np.uint64(0x9E3779B97F4A7C15)
            grams[:, GRAMS.index(n + 1)] = hashed >> bucket
    return grams.reshape(-1), np.searchsorted(at, offsets[1:]) * len(GRAMS)


class Model:
    """Codewords, the classifiers' weights per bucket, and the weights of their losses."""

    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages = languages
        self.code = codewords(len(languages))
        self.trust = np.ones(self.code.shape[1])
        if len(languages) < 2:
            return
        positive = (self.code > 0).astype(np.float64).T
        smooth = lambda c: (c + SMOOTHING) / (c.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
        # Languages count alike, however much text of each there is.
        rates = smooth(counts.astype(np.float64))
        share = lambda mask: mask @ rates / mask.sum(axis=1, keepdims=True)
        self.weights = np.log(share(positive) / share(1 - positive)).astype(np.float32)

    def margins(self, texts: pa.Array) -> np.ndarray:
        """Mean weight per text and bit; zeros for texts without n-grams."""
        grams, ends = _grams(texts)
        starts = np.concatenate(([0], ends[:-1]))
        sizes = ends - starts
        sums = np.zeros((len(ends), len(self.weights)))
        some = np.flatnonzero(sizes)
        for bit, weights in enumerate(self.weights if len(some) else ()):
            sums[some, bit] = np.add.reduceat(weights.take(grams), starts[some], dtype=np.float64)
        return sums / np.maximum(sizes, 1)[:, None]

    def weigh(self, margins: np.ndarray, labels: np.ndarray) -> None:
        """Trust a bit's classifier by how far apart its two sides' margins are, in units of their spread."""
        for bit in range(self.code.shape[1]):
            signed = margins[:, bit] * self.code[labels, bit]
            self.trust[bit] = max(0.05, signed.mean() / (signed.std() + 1e-6))
        self.trust /= self.trust.mean()

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number (-1: und), score, and whether the runner-up is close."""
        n = len(texts)
        has_letter = pc.match_substring_regex(pc.fill_null(texts, ""), r"\p{L}").to_numpy(zero_copy_only=False)
        if len(self.languages) < 2:
            best = np.where(has_letter, len(self.languages) - 1, -1)
            return best, (best >= 0).astype(np.float64), np.zeros(n, dtype=bool)
        loss = lambda side: np.logaddexp(0, -SHARPNESS * side)
        margins = self.margins(texts)
        distance = np.zeros((n, len(self.languages)))
        for i, word in enumerate(self.code):
            distance[:, i] = (loss(margins * word) * self.trust).sum(axis=1)
        share = np.exp(distance.min(axis=1, keepdims=True) - distance)
        share /= share.sum(axis=1, keepdims=True)
        best = distance.argmin(axis=1)
        ranked = np.sort(share, axis=1)
        close = ranked[:, -1] - ranked[:, -2] < AMBIGUITY
        return np.where(has_letter, best, -1), np.where(has_letter, ranked[:, -1], 0.0), close & has_letter


def held_out(doc_id: Column) -> Column:
    """Rows whose checksum of the id keeps them out of training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sample(documents: DataFrame) -> DataFrame:
    """About SAMPLE_ROWS training rows (text, lang) per language, by hash of the id; all rows of a smaller language."""
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # One number per language, which the codebook needs on the driver anyway; joining it would move all texts.
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    wanted = F.lit(False)
    for lang, n in sorted(sizes.items()):
        wanted = wanted | ((F.col("lang") == lang) & (place < SAMPLE_ROWS / n))
    return rows.filter(wanted).select("text", "lang")


def train(documents: DataFrame) -> Model:
    """Fit on the sample. Counts and margins, not texts, come to the driver: languages x BUCKETS numbers."""
    rows = sample(documents)
    languages = [r["lang"] for r in rows.select("lang").distinct().orderBy("lang").collect()]
    number = {lang: i for i, lang in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        for batch in slices(batches, "text"):
            grams, ends = _grams(batch.column("text"))
            labels = np.array([number[x] for x in batch.column("lang").to_pylist()])
            sizes = np.diff(np.concatenate(([0], ends)))
            counts += np.bincount(np.repeat(labels, sizes) * BUCKETS + grams, minlength=counts.size).reshape(counts.shape)
        label, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(label.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(counts[label, bucket])],
            ["label", "bucket", "n"],
        )

    counts = np.zeros((len(languages), BUCKETS), dtype=np.int64)
    counted = rows.mapInArrow(count, "label int, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    counts[table["label"].to_numpy(), table["bucket"].to_numpy()] = table["n"].to_numpy()
    model = Model(languages, counts)
    if len(languages) < 2:
        return model
    bits = model.code.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            margins = model.margins(batch.column("text"))
            labels = np.array([number[x] for x in batch.column("lang").to_pylist()], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels), pa.array(margins.tolist(), pa.list_(pa.float64()))], ["label", "margins"]
            )

    measured = rows.mapInArrow(measure, "label int, margins array<double>").toArrow()
    model.weigh(np.array(measured["margins"].to_pylist()).reshape(-1, bits), measured["label"].to_numpy())
    return model


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of the documents and lang_pred, score, ambiguous (replacing columns of these names)."""
    found = ["lang_pred", "score", "ambiguous"]
    kept = documents.drop(*found)
    names = np.array([*model.languages, UNKNOWN], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            best, score, close = model.predict(batch.column("text"))
            columns = [pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array(close)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *found])

    schema = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes)
    return kept.withColumn("text", F.col("text").cast("string")).mapInArrow(
        run, f"{schema}, lang_pred string, score double, ambiguous boolean"
    )
