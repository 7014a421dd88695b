"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on text of toxic documents and one on ordinary text. A
window of a text that the toxic dictionary compresses to a small part of what it costs by the
ordinary one leans toxic. A document is judged by how many of its windows lean, strongly or less so,
and by their share; a logistic curve over these, fitted on labelled rows that the dictionaries in question have not seen,
calibrates the score.

A window is one word between blanks. So short a text zstandard would store as it is; the window is
therefore compressed between a carrier that both dictionaries end with and a fixed tail (the last
bytes of a text are never matched), and costs what it adds. Words repeat, so a worker remembers what it has compressed, up to ``REMEMBERED`` windows.

Learning uses at most ``FIT_ROWS`` labelled rows of each label, chosen by a hash of the id; the
dictionaries have a fixed size. Scoring reads whole texts of all documents, row by row.

Defined results: a null or empty text has no windows and scores the lowest there is. Where a label
has no training rows, as in an empty table, every score is 0. A document with several labels trains
with the greatest; of several texts of one id the least trains. Equal texts have equal scores. A text
of any length is looked at whole, word by word. Other columns of the table are not read.
"""

import collections

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from spokeframe.llm.columns import only
from spokeframe.llm.workers import tidy
from spokeframe.session import through_table

FIT_ROWS = 4000
DICTIONARY_BYTES = 16 << 10
REMEMBERED = 150_000

# A search deep enough to find the longest match among many that begin alike.
SEARCH = {"window_log": 17, "hash_log": 13, "chain_log": 14, "search_log": 9, "min_match": 3,
          "strategy": 5}
THRESHOLD = 0.7

# How much commoner in toxic texts than in ordinary ones a word of the toxic dictionary is.
TELLING = 40

CARRIER, TAIL = bytes(range(128, 192)), bytes(range(240, 252))

# A window leans if it is ``LEAST`` bytes shorter by the toxic dictionary and costs at most one of
# these shares of what it costs by the ordinary one; each share is counted and the fit weighs them.
LEAST, SHARES = 3, (0.0, 1 / 7, 1 / 4)


class Leaning:
    """How strongly a window leans toxic: the number of ``SHARES`` that it keeps to."""

    def __init__(self, toxic, ordinary):
        import zstandard

        def sizer(content):
            dictionary = zstandard.ZstdCompressionDict(
                content + CARRIER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            parameters = zstandard.ZstdCompressionParameters(
                format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False,
                write_checksum=False, write_dict_id=False, **SEARCH)
            dictionary.precompute_compress(compression_params=parameters)
            return zstandard.ZstdCompressor(
                dict_data=dictionary, compression_params=parameters).compress

        self.toxic, self.ordinary = sizer(toxic), sizer(ordinary)
        self.known = {}
        empty = CARRIER + b"  " + TAIL
        self.base = len(self.toxic(empty)), len(self.ordinary(empty))

    def learn(self, windows):
        known = self.known
        for window in windows:
            data = CARRIER + b" " + window + b" " + TAIL
            toxic = max(len(self.toxic(data)) - self.base[0], 0)
            # No window costs more than its bytes and a few; most need not be tried again.
            if toxic > SHARES[-1] * (len(window) + 8):
                known[window] = 0
                continue
            ordinary = len(self.ordinary(data)) - self.base[1]
            known[window] = 0 if ordinary - toxic < LEAST else sum(
                toxic <= share * ordinary for share in SHARES)

    def features(self, text):
        """Per document and share: how many windows lean, and how many of a hundred."""
        windows = text.lower().encode().split()
        if not windows:
            return (0.0,) * (2 * len(SHARES))
        if len(self.known) > REMEMBERED:
            self.known = {}
        self.learn(set(windows).difference(self.known))
        kept = np.bincount(np.fromiter(map(self.known.__getitem__, windows), dtype=np.int64,
                                       count=len(windows)), minlength=len(SHARES) + 1)
        # The narrowest share first: a window that keeps to it keeps to the wider ones.
        counts = np.cumsum(kept[:0:-1])
        return (*np.log1p(counts), *(100.0 * counts / (len(windows) + 20)))


def _dictionary(texts, other, size):
    """Train on the words that at least one text in three hundred has and that are
    ``TELLING`` times as common as in ``other`` texts.

    The commonest follow once more as they are, so that the nearest match is the likeliest.
    """
    import zstandard

    seen = collections.Counter(word for words in texts for word in words)
    elsewhere = collections.Counter(word for words in other for word in words)
    bound = TELLING * len(texts) / max(len(other), 1)
    seen = {word: n for word, n in seen.items() if n > bound * elsewhere[word]}
    least = max(2, len(texts) // 300)
    common = sorted((w for w, n in seen.items() if n >= least), key=lambda w: (-seen[w], w))
    samples = [b" " + w for w in common for _ in range(min(seen[w], 50))]
    try:
        trained = zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on
        trained = b""
    plain, used = [], 0
    for word in common:
        used += len(word) + 1
        if used > size:
            break
        plain.append(b" " + word)
    return trained[-size:] + b"".join(reversed(plain)) + b" "


def _fit_logistic(x, y, rounds=60, ridge=1e-2):
    x = np.column_stack([np.ones(len(x)), x])
    weights = np.zeros(x.shape[1])
    penalty = np.eye(x.shape[1]) * ridge
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + penalty @ weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def _dictionaries(toxic_texts, ordinary_texts):
    toxic, ordinary = ([set(t.lower().encode().split()) for t in texts]
                       for texts in (toxic_texts, ordinary_texts))
    return (_dictionary(toxic, ordinary, DICTIONARY_BYTES),
            _dictionary(ordinary, [], DICTIONARY_BYTES))


def fit(rows):
    """``(toxic dictionary, ordinary dictionary, weights)`` of rows ``text, toxic``.

    The curve is fitted on each half of the rows as judged by dictionaries of the other half; the
    dictionaries that are kept are trained on all. None where a label has fewer than two rows.
    """
    texts = {0: [], 1: []}
    for text, label in rows:
        texts[label].append(text)
    if min(map(len, texts.values())) < 2:
        return None
    x, y = [], []
    for part in (0, 1):
        leaning = Leaning(*_dictionaries(texts[1][part::2], texts[0][part::2]))
        for label in (0, 1):
            judged = texts[label][1 - part::2]
            x += map(leaning.features, judged)
            y += [float(label)] * len(judged)
    return *_dictionaries(texts[1], texts[0]), _fit_logistic(np.array(x), np.array(y))


def training_ids(docs, labels, fit_rows=FIT_ROWS):
    """``chosen, toxic``: at most ``fit_rows`` ids of each label, the same whenever asked.

    No text is read for it. A label's ids are thinned by a hash to about twice as many as are wanted
    before they are ordered, so what all partitions send together is bounded as well.
    """
    marked = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic IN (0, 1)")
    met = through_table(docs.select("doc_id").distinct().join(marked, "doc_id"))
    numbers = {r["toxic"]: r["n"] for r in met.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sides = [met.where((F.col("toxic") == label) & (draw < 2 * fit_rows / numbers.get(label, 1)))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows) for label in (0, 1)]
    return through_table(sides[0].union(sides[1]).withColumnRenamed("doc_id", "chosen"))


def training_rows(docs, labels, fit_rows=FIT_ROWS):
    """``text, toxic, order`` of the chosen ids: one text an id, so at most ``fit_rows`` of a label."""
    # Two times ``fit_rows`` ids at most: small enough to send to all tasks.
    ids = F.broadcast(training_ids(docs, labels, fit_rows))
    found = docs.join(ids, docs["doc_id"] == F.col("chosen")).where("text IS NOT NULL")
    return found.groupBy("chosen", "toxic").agg(F.min("text").alias("text")).select(
        "text", "toxic", F.md5(F.concat_ws("|", F.col("chosen").cast("string"), "text")).alias("order"))


def learn(docs, labels, fit_rows=FIT_ROWS):
    """The fitted model of labelled documents, made in one task from a bounded sample."""
    def run(frames):
        frames = [f for f in frames if len(f)]
        if not frames:
            return
        rows = pd.concat(frames).sort_values("order")
        model = fit(zip(rows["text"], rows["toxic"].astype(int)))
        if model:
            yield pd.DataFrame({"toxic": [model[0]], "ordinary": [model[1]],
                                "weights": [model[2].tolist()]})

    found = training_rows(docs, labels, fit_rows).coalesce(1).mapInPandas(
        tidy(run), "toxic binary, ordinary binary, weights array<double>").first()
    return (bytes(found["toxic"]), bytes(found["ordinary"]), list(found["weights"])) if found \
        else None


def with_scores(docs, model, text="text", score="score"):
    """Add the score of each row's whole text. The rows' other columns pass through."""
    import pyarrow as pa

    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fitted = broadcast.value
        leaning = Leaning(*fitted[:2]) if fitted else None
        weights = np.array(fitted[2]) if fitted else None
        for batch in batches:
            texts = batch.column(text).to_pylist()
            if fitted:
                x = np.array([leaning.features(t or "") for t in texts])
                z = np.clip(weights[0] + x @ weights[1:], -30, 30) if len(x) else np.zeros(0)
                scores = 1 / (1 + np.exp(-z))
            else:
                scores = np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())],
                names=[*batch.schema.names, score])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(tidy(run), f"{schema}, `{score}` double")


def held_out(doc_id, parts=3, part=1):
    """Rows that labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(False))


def score_documents(docs, labels, fit_rows=FIT_ROWS, doc_id="doc_id", text="text"):
    """``doc_id, held_out, score, predicted`` of every document."""
    plain = only(docs, doc_id=doc_id, text=text).withColumn("held_out", held_out("doc_id"))
    model = learn(plain.where(~F.col("held_out")), labels, fit_rows)
    scored = with_scores(plain, model)
    return scored.select("doc_id", "held_out", "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
