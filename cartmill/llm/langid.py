"""Language identification with a small convolutional network over bytes.

Bytes of the lower-cased text are embedded; filters of several widths slide over windows of a
fixed length; each filter's largest response in a window feeds a softmax. The network is
trained in numpy on a bounded sample of labelled windows and applied to every window of every
text; a text's probabilities are the means over its windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartmill.llm.store import keep, small, without

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDED = 6
#: Bounds of the training sample: documents of each language, windows of each document.
DOCUMENTS, SLICES = 300, 6
EPOCHS, BATCH, RATE = 14, 64, 0.01
UNKNOWN = "und"
#: Windows that a task scores at once.
AT_ONCE = 128


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    offset: np.ndarray

    def patches(self, codes: np.ndarray, width: int) -> np.ndarray:
        """(windows, places, width * EMBEDDED): the embedded bytes under a filter at each place."""
        x = self.embedding[codes]
        view = np.lib.stride_tricks.sliding_window_view(x, width, axis=1)
        return view.transpose(0, 1, 3, 2).reshape(x.shape[0], -1, width * EMBEDDED)

    def tables(self) -> list[list[np.ndarray]]:
        """What a filter adds up over its width, by pair of neighbouring bytes and, for an odd
        width, by its last byte: far fewer sums than embedding and multiplying every place."""
        out = []
        for width, f in zip(WIDTHS, self.filters):
            at = [self.embedding @ f[k * EMBEDDED : (k + 1) * EMBEDDED] for k in range(width)]
            pairs = [(at[k][:, None] + at[k + 1][None]).reshape(65536, -1) for k in range(0, width - 1, 2)]
            out.append(pairs + [at[-1]] * (width % 2))
        return out

    def pooled(self, codes: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        n, length = codes.shape
        pairs = codes[:, :-1].astype(np.int64) * 256 + codes[:, 1:]
        alone = codes.astype(np.int64)
        one, two = np.empty((2, n * length * FILTERS), np.float32)
        out = []
        for width, parts, b in zip(WIDTHS, tables, self.biases):
            places = length - width + 1
            shape, room = (n, places, FILTERS), n * places * FILTERS
            response, more = one[:room].reshape(shape), two[:room].reshape(shape)
            for k, table in enumerate(parts):
                of = pairs if len(table) == 65536 else alone
                into = more if k else response
                np.take(table, of[:, 2 * k : 2 * k + places], axis=0, out=into, mode="clip")
                if k:
                    response += more
            flat = response.reshape(n, -1)
            while places > 1:  # the larger of the first and the last places, until one is left
                half = places // 2
                first, last = flat[:, : half * FILTERS], flat[:, (places - half) * FILTERS : places * FILTERS]
                np.maximum(first, last, out=first)
                places -= half
            out.append(flat[:, :FILTERS] + b)
        return np.maximum(np.concatenate(out, 1), 0)

    def probabilities(self, codes: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        z = self.pooled(codes, tables) @ self.weights + self.offset
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def windows(text: str) -> np.ndarray:
    """All bytes of a text in rows of WINDOW, the last filled up with zeros."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    out = np.zeros(max(1, -(-len(raw) // WINDOW)) * WINDOW, np.uint8)
    out[: len(raw)] = raw
    return out.reshape(-1, WINDOW)


def train(samples: list[tuple[str, str]], seed: int = 7) -> Network | None:
    """A network fitted to (language, text) pairs; None without any."""
    languages = sorted({x for x, _ in samples})
    if not languages:
        return None
    samples = sorted(samples)
    index = {x: i for i, x in enumerate(languages)}
    codes = np.concatenate([windows(t)[:1] for _, t in samples])
    target = np.array([index[x] for x, _ in samples])
    rng = np.random.default_rng(seed)
    small = lambda *shape: rng.normal(0, (2 / shape[0]) ** 0.5, shape).astype(np.float32)
    net = Network(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDED)).astype(np.float32),
        [small(w * EMBEDDED, FILTERS) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        small(FILTERS * len(WIDTHS), len(languages)),
        np.zeros(len(languages), np.float32),
    )
    params = [net.embedding, *net.filters, *net.biases, net.weights, net.offset]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    # Rare languages weigh as much as frequent ones.
    weight = (len(samples) / len(languages) / np.bincount(target, minlength=len(languages)))[target].astype(np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(samples))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            step += 1
            for p, g, m, v in zip(params, _gradients(net, codes[pick], target[pick], weight[pick]), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _gradients(net: Network, codes: np.ndarray, target: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    n = len(codes)
    rows = np.arange(n)[:, None]
    taken, places, pooled = [], [], []
    for width, f, b in zip(WIDTHS, net.filters, net.biases):
        p = net.patches(codes, width)
        response = p @ f
        best = response.argmax(1)
        places.append(best)
        taken.append(p[rows, best])
        pooled.append(np.take_along_axis(response, best[:, None], 1)[:, 0] + b)
    hidden = np.maximum(np.concatenate(pooled, 1), 0)
    z = hidden @ net.weights + net.offset
    e = np.exp(z - z.max(1, keepdims=True))
    slope = e / e.sum(1, keepdims=True)
    slope[np.arange(n), target] -= 1
    slope *= weight[:, None] / n
    back = (slope @ net.weights.T) * (hidden > 0)
    embedding = np.zeros_like(net.embedding)
    filters, biases = [], []
    for i, (width, f) in enumerate(zip(WIDTHS, net.filters)):
        g = back[:, i * FILTERS : (i + 1) * FILTERS]
        filters.append(np.einsum("nfp,nf->pf", taken[i], g, optimize=True))
        biases.append(g.sum(0))
        into = (g[:, :, None] * f.T[None]).reshape(n, FILTERS, width, EMBEDDED)
        at = codes[rows[:, :, None], places[i][:, :, None] + np.arange(width)]
        np.add.at(embedding, at, into)
    return [embedding, *filters, *biases, hidden.T @ slope, slope.sum(0)]


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id as text is 2 modulo 4, or the id is null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def training_sample(docs: DataFrame, doc_id: str, text: str, lang: str) -> list[tuple[str, str]]:
    """At most DOCUMENTS * SLICES stretches of text of every language, from documents in hash order.

    Only ids and labels are ranked; texts are cut into stretches before they come to the driver.
    """
    labelled = docs.where(~held_out(docs[f"`{doc_id}`"]) & docs[f"`{lang}`"].isNotNull() & docs[f"`{text}`"].isNotNull())
    names = labelled.groupBy(F.col(f"`{lang}`").alias("l")).agg(F.count("*").alias("n"))
    # About twice DOCUMENTS of each language pass this filter on the hash of the id; the order
    # of that hash then picks the DOCUMENTS first, in whatever way the rows are dealt out.
    names = keep(names.select("l", F.least(F.lit(1.0), 2 * DOCUMENTS / F.col("n")).alias("share")), "languages")
    size = names.agg(F.sum(64 + F.octet_length("l"))).first()[0]
    if size is None:
        return []
    at = F.pmod(F.xxhash64(F.col(f"`{doc_id}`").cast("string")), F.lit(1 << 20))
    given = labelled.select(F.col(f"`{lang}`").alias("l"), at.alias("at"), F.col(f"`{text}`").alias("body"))
    passed = given.join(small(names, size, 1), "l").where(F.col("at") < F.col("share") * (1 << 20))
    step = F.ceil(F.length("body") / SLICES).cast("int")
    near = passed.select(
        "l",
        "at",
        F.transform(
            F.sequence(F.lit(0), F.lit(SLICES - 1)), lambda k: F.col("body").substr(k * step + 1, F.lit(WINDOW))
        ).alias("parts"),
    )

    first = F.row_number().over(Window.partitionBy("l").orderBy("at", "parts"))
    picked = near.withColumn("r", first).where(F.col("r") <= DOCUMENTS).select("l", "parts").collect()
    return [(r["l"], p) for r in picked for p in dict.fromkeys(r["parts"]) if any(map(str.isalpha, p))]


def identify(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    network: Network | None = None,
) -> DataFrame:
    """The documents with held_out boolean, lang_pred string and score double.

    Without a `network`, one is trained from the documents that aren't held out. Predictions
    depend on the text alone. lang_pred is `und` with score 0 for a text that is null or has
    no letter, and for all texts where there was nothing to learn from; of equally probable
    languages the first by name is taken. Every row is kept, repeated ones too, and whole
    texts are scored; input columns named like a result are replaced.
    """
    if network is None:
        samples = training_sample(docs, doc_id, text, lang)
        network = train(samples) if samples else None
    rows = without(docs, "held_out", "lang_pred", "score")
    kept = rows.withColumn("held_out", held_out(rows[f"`{doc_id}`"]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def predict(batches):
        import pyarrow as pa

        tables = network.tables() if network else None
        for batch in batches:
            names, scores = label(network, tables, batch.column(text))
            arrays = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "lang_pred", "score"])

    return kept.mapInArrow(predict, f"{fields}, lang_pred string, score double")


def label(network: Network | None, tables, texts) -> tuple[list[str], list[float]]:
    """The language and score of each text; long texts are scored AT_ONCE windows at a time."""
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if network is None:
        return names, scores
    owner: list[int] = []
    held: list[np.ndarray] = []
    waiting = 0
    sums = np.zeros((len(texts), len(network.languages)))
    seen = np.zeros(len(texts))

    def flush():
        nonlocal waiting
        codes, of = np.concatenate(held), np.repeat(owner, [len(h) for h in held])
        for at in range(0, len(codes), AT_ONCE):
            part = slice(at, at + AT_ONCE)
            np.add.at(sums, of[part], network.probabilities(codes[part], tables))
        np.add.at(seen, of, 1)
        owner.clear()
        held.clear()
        waiting = 0

    for i, value in enumerate(texts):
        t = value.as_py() if hasattr(value, "as_py") else value
        if t is None or not any(map(str.isalpha, t)):
            continue
        owner.append(i)
        held.append(windows(t))
        waiting += len(held[-1])
        if waiting >= 8 * AT_ONCE:
            flush()
    if held:
        flush()
    for i in np.flatnonzero(seen):
        mean = sums[i] / seen[i]
        best = int(mean.argmax())
        names[i], scores[i] = network.languages[best], float(min(1.0, mean[best]))
    return names, scores
