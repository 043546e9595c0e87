"""Language-model scoring with a gated recurrent network in numpy.

Words are counted over all training documents. The network's outputs are the end
of a text, the most frequent words, and a bucket by ending for each other word;
inside its bucket a word has its smoothed share of the bucket's count, so every
word of every text has a probability. The softmax is factored into classes:
P(class | state) * P(output | class, state).

Documents become arrays of small numbers in one pass over the text. Each chunk
of documents has its own dictionary, whose words meet their corpus counts in one
shuffle of distinct words per chunk, never of running words. The network is
trained by truncated backpropagation over every window of every training
document (the state is carried from window to window, no gradient). The pass is
dealt to rounds by documents: in each round every task starts from the same
weights, learns from its documents of that round, and the weights are averaged in
a tree by tokens. Scoring carries the state across the windows of a whole document."""

from __future__ import annotations

import math
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, text_of, written

CLASSES, PER_CLASS = 32, 32
OUTPUTS = CLASSES * PER_CLASS
#: Outputs that stand for words outside the vocabulary.
BUCKETS = 64
#: The end of a text and the most frequent words.
VOCABULARY = OUTPUTS - BUCKETS
HIDDEN = 24
#: Tokens of a backpropagation window.
WINDOW = 16
#: Parts of the one pass over all training documents; weights are averaged after each.
ROUNDS = 3
#: Documents that step together: at a task's start, one more for every ``GROWTH``
#: documents begun (a small corpus needs its updates), and at most.
START, GROWTH, BATCH = 32, 4, 512
RATE = 0.01
#: Words after which a chunk of documents is closed.
CHUNK_WORDS = 2_000_000
#: Steps, and about how many tokens, whose outputs are scored at a time.
SCORE_WINDOW, SCORE_TOKENS = 256, 16_384
#: Documents, and tokens, that a task scores side by side.
SCORE_DOCUMENTS, SCORE_HELD = 20_000, 4_000_000
FAN_IN = 32

ENCODED = ("kind string, chunk long, doc_id long, held_out boolean, n_tokens long, ids binary, "
           "lid int, word binary, cnt long")
CODED = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, rest_score double, codes binary")


def _encoded(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, held_out, text) as number arrays (kind 'doc') and the
    words of each chunk with their counts in training documents (kind 'word').
    The empty word is the end of a text."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(),
                                 "binary": pa.binary()}[t]) for n, t in (c.split() for c in ENCODED.split(", "))])
        chunk = TaskContext.get().partitionId() << 24

        def emit(**columns):
            n = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
                                               for f in schema], schema=schema)

        class Ids(dict):
            def __missing__(self, word):
                self[word] = len(self)
                return self[word]

        lids, counts, words_held = Ids({b"": 0}), np.zeros(1024, dtype=np.int64), 0

        def words():
            names = list(lids)
            for at in range(0, len(names), 50_000):
                part = names[at:at + 50_000]
                yield emit(kind=["word"] * len(part), chunk=[chunk] * len(part), lid=list(range(at, at + len(part))),
                           word=part, cnt=counts[at:at + len(part)])

        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                keys, held, texts = (batch.column(i).slice(at, 1_000).to_pylist() for i in range(3))
                ids = []
                for t in texts:
                    w = t.encode().lower().split()
                    a = np.fromiter(map(lids.__getitem__, w), dtype="<u4", count=len(w))
                    ids.append(np.append(a, np.uint32(0)))
                while len(counts) < len(lids):
                    counts = np.concatenate([counts, np.zeros(len(counts), dtype=np.int64)])
                train = [a for a, h in zip(ids, held) if not h]
                if train:
                    seen = np.bincount(np.concatenate(train))
                    counts[:len(seen)] += seen
                yield emit(kind=["doc"] * len(keys), chunk=[chunk] * len(keys), doc_id=keys, held_out=held,
                           n_tokens=[len(a) for a in ids], ids=[a.tobytes() for a in ids])
                words_held += sum(map(len, ids))
                if words_held >= CHUNK_WORDS:
                    yield from words()
                    lids, counts, words_held, chunk = Ids({b"": 0}), np.zeros(1024, dtype=np.int64), 0, chunk + 1
        if words_held:
            yield from words()

    return docs.mapInArrow(run, ENCODED)


def _bucket(word):
    """Output of a word outside the vocabulary, by its ending."""
    return F.crc32(F.substring(word, -2, 2)) % BUCKETS


class Network:
    """Gated recurrent unit with a class-factored softmax; float32 weights. Gates
    (update, reset, new) stand side by side in front, so that each is one block of
    memory; the last row of ``wc`` and ``wo`` is the bias."""

    SHAPES = {"x": (3, OUTPUTS, HIDDEN), "u": (3, HIDDEN, HIDDEN), "wc": (HIDDEN + 1, CLASSES), "wo": (CLASSES, HIDDEN + 1, PER_CLASS)}

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def start(cls, share: np.ndarray, seed: int = 7) -> Network:
        """Small random weights; output biases give the ``share`` of each output."""
        rng = np.random.default_rng(seed)
        w = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in cls.SHAPES.items()}
        share = (share.reshape(CLASSES, PER_CLASS) + 1e-7)
        w["wc"] *= 0.1
        w["wo"] *= 0.1
        w["wc"][-1] = np.log(share.sum(axis=1))
        w["wo"][:, -1] = np.log(share / share.sum(axis=1, keepdims=True))
        return cls(w)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w[k].ravel() for k in self.SHAPES])

    @classmethod
    def of(cls, flat: np.ndarray) -> Network:
        w, at = {}, 0
        for k, s in cls.SHAPES.items():
            n = math.prod(s)
            w[k] = flat[at:at + n].reshape(s).astype(np.float32)
            at += n
        return cls(w)

    def step(self, h: np.ndarray, codes: np.ndarray):
        """Next state, and what the backward pass needs."""
        a, hu = self.w["x"].take(codes, axis=1), np.matmul(h, self.w["u"])
        zr = a[:2]
        zr += hu[:2]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r, n = a
        n += r * hu[2]
        np.tanh(n, out=n)
        new = h - n
        new *= z
        new += n
        return new, (h, z, r, n, hu[2])

    def outputs(self, states: np.ndarray, codes: np.ndarray, grads: dict | None = None):
        """ln P of each code given its state; with ``grads``, adds to them and
        returns the gradient of the negative log likelihood by state too. Rows are
        put in the order of their codes once, so that a class is a slice; logits
        have a column for each row."""
        w, n = self.w, len(codes)
        order = np.argsort(codes.astype(np.uint16), kind="stable")
        c, at = codes[order], np.arange(n)
        h = np.ones((n, HIDDEN + 1), dtype=states.dtype)
        np.take(states, order, axis=0, out=h[:, :-1])
        cls, member = c // PER_CLASS, c % PER_CLASS
        bounds = np.searchsorted(cls, np.arange(CLASSES + 1)).tolist()
        slices = [(k, slice(x, y)) for k, (x, y) in enumerate(zip(bounds, bounds[1:])) if x < y]

        def log_softmax(logits, rows):
            """Of ``rows``; logits become exponentials, whose sums are returned too."""
            logits -= logits.max(axis=0)
            picked = logits[rows, at]
            np.exp(logits, out=logits)
            total = logits.sum(axis=0)
            return picked - np.log(total), total

        outer = w["wc"].T @ h.T
        inner = np.empty((PER_CLASS, n), dtype=outer.dtype)
        for k, part in slices:
            np.matmul(w["wo"][k].T, h[part].T, out=inner[:, part])
        lp, total = log_softmax(outer, cls)
        lp_member, total_member = log_softmax(inner, member)
        out = np.empty(n, dtype=lp.dtype)
        out[order] = lp + lp_member
        if grads is None:
            return out, None
        outer /= total
        outer[cls, at] -= 1
        inner /= total_member
        inner[member, at] -= 1
        grads["wc"] += h.T @ outer.T
        d = outer.T @ w["wc"][:-1].T
        for k, part in slices:
            grads["wo"][k] += h[part].T @ inner[:, part].T
            d[part] += inner[:, part].T @ w["wo"][k, :-1].T
        back = np.empty_like(d)
        back[order] = d
        return out, back

    def window(self, h: np.ndarray, codes: np.ndarray, mask: np.ndarray):
        """One truncated window (batch x time), or several in a row (whole ones of
        ``WINDOW`` steps): gradients, loss and last state. The state is carried
        through them; the backward pass takes the windows of all lanes side by side."""
        b, steps = codes.shape
        length = min(steps, WINDOW)
        runs = steps // length
        states, caches = np.empty((steps, b, HIDDEN), dtype=h.dtype), []
        for t in range(steps):
            states[t] = h
            h, cache = self.step(h, codes[:, t])
            caches.append(cache)
        grads = {k: np.zeros(s, dtype=self.w[k].dtype) for k, s in self.SHAPES.items()}
        flat, real = codes.T.ravel(), np.flatnonzero(mask.T)
        back = np.zeros((steps * b, HIDDEN), dtype=self.w["x"].dtype)
        lp, back[real] = self.outputs(states.reshape(-1, HIDDEN)[real], flat[real], grads)
        back = back.reshape(runs, length, b, HIDDEN)
        d = np.zeros((runs * b, HIDDEN), dtype=back.dtype)
        dx, du = np.empty((3, length, runs * b, HIDDEN), dtype=back.dtype), np.empty((3, runs * b, HIDDEN), dtype=back.dtype)
        turned = self.w["u"].transpose(0, 2, 1)
        for t in range(length - 1, -1, -1):
            prev, z, r, n, hn = caches[t] if runs == 1 else map(np.concatenate, zip(*caches[t::length]))
            dz, dr, dn = (gate[t] for gate in dx)
            rest = 1 - z
            np.multiply(d, rest, out=dn)
            np.multiply(d, prev - n, out=dz)
            dz *= z
            dz *= rest
            dn *= 1 - n * n
            np.multiply(dn, hn, out=dr)
            dr *= r
            dr *= 1 - r
            du[0], du[1] = dz, dr
            np.multiply(dn, r, out=du[2])
            grads["u"] += np.matmul(prev.T, du)
            d *= z
            d += np.matmul(du, turned).sum(axis=0)
            d += back[:, t].reshape(-1, HIDDEN)
        flat = flat.reshape(runs, length, b).swapaxes(0, 1).ravel()
        order = np.argsort(flat.astype(np.uint16), kind="stable")
        ranked = flat[order]
        starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        grads["x"][:, ranked[starts]] = np.add.reduceat(dx.reshape(3, -1, HIDDEN).take(order, axis=1), starts, axis=1)
        return grads, float(-lp.sum()), h

    def log_probability(self, docs: list[np.ndarray]) -> np.ndarray:
        """ln P of each whole document; all step together, longest first, and the
        state goes from window to window."""
        order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
        lengths = np.array([len(docs[i]) for i in order], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        flat = np.concatenate([docs[i] for i in order]) if docs else np.zeros(0, np.int64)
        total = np.zeros(len(docs))
        h = np.zeros((len(docs), HIDDEN), dtype=np.float32)
        t, most = 0, int(lengths[0]) if len(docs) else 0
        while t < most:
            states, codes, owner, held = [], [], [], 0
            while t < most and len(owner) < SCORE_WINDOW and held < SCORE_TOKENS:
                n = int(np.searchsorted(-lengths, -t, side="left"))  # documents longer than t
                c = flat[starts[:n] + t].astype(np.int64)
                h = h[:n]
                states.append(h)
                codes.append(c)
                owner.append(n)
                held += n
                h, _ = self.step(h, c)
                t += 1
            lp, _ = self.outputs(np.concatenate(states), np.concatenate(codes))
            at = 0
            for n in owner:
                total[:n] += lp[at:at + n]
                at += n
        out = np.empty(len(docs))
        out[order] = total
        return out


def _learn(network: Network, docs, rate: float) -> tuple[Network, int]:
    """Adam over every window of every document, and how many tokens that were.
    Lanes step together; one whose document has ended takes the next one at state
    zero, otherwise the state goes on to the document's next window. Where few
    lanes are left, windows are summed until they hold a fourth of a full one."""
    docs, lanes, begun, h = iter(docs), [], 0, np.zeros((0, HIDDEN), dtype=np.float32)
    w, m, v, k, learnt = network.w, {}, {}, 0, 0
    for name, s in Network.SHAPES.items():
        m[name], v[name] = np.zeros(s, np.float32), np.zeros(s, np.float32)
    held, n = {}, 0

    def update():
        nonlocal held, n, k
        k += 1
        for name, g in held.items():
            g *= WINDOW / n
            np.clip(g, -1, 1, out=g)
            m[name] *= 0.9
            m[name] += 0.1 * g
            g *= g
            g *= 0.01
            v[name] *= 0.99
            v[name] += g
            np.divide(v[name], 1 - 0.99**k, out=g)
            np.sqrt(g, out=g)
            g += 1e-6
            np.divide(m[name], g, out=g)
            g *= rate / (1 - 0.9**k)
            w[name] -= g
        held, n = {}, 0

    while True:
        on = [i for i, (d, at) in enumerate(lanes) if at < len(d)]
        width = min(BATCH, START + begun // GROWTH)
        fresh = [(d, 0) for d in islice(docs, width - len(on))]
        begun += len(fresh)
        lanes = [lanes[i] for i in on] + fresh
        h = np.concatenate([h[on], np.zeros((len(fresh), HIDDEN), dtype=np.float32)])
        if not lanes:
            break
        # few lanes are left: the windows that one update sums are taken together
        runs = min(-(-width // (4 * len(lanes))), max(-(-(len(d) - at) // WINDOW) for d, at in lanes))
        steps = max(runs, 1) * WINDOW
        codes = np.zeros((len(lanes), steps), dtype=np.int64)
        for i, (d, at) in enumerate(lanes):
            part = d[at:at + steps]
            codes[i, :len(part)] = part
            lanes[i] = d, at + steps
        mask = np.arange(steps) < np.array([len(d) - at for d, at in lanes])[:, None] + steps
        grads, _, h = network.window(h, codes, mask)
        for name, g in held.items():
            grads[name] += g
        held, size = grads, int(mask.sum())
        n += size
        learnt += size
        if 4 * n >= width * WINDOW:
            update()
    if n:
        update()
    return network, learnt


def train(coded: DataFrame, share: np.ndarray, rounds: int = ROUNDS) -> Network:
    """One pass over every window of the training documents. Each is learnt from
    in one of the ``rounds`` of local training and weight averaging; rounds
    without documents change nothing."""
    network = Network.start(share)
    rows = coded.filter("not held_out").select("codes", F.pmod(F.xxhash64("doc_id", "codes"), F.lit(rounds)).alias("round"))

    def average(pdf):
        import pandas as pd

        n = pdf["n"].to_numpy(dtype=np.float64)
        flat = sum(np.frombuffer(w, "<f4").astype(np.float64) * (k / n.sum()) for w, k in zip(pdf["weights"], n))
        return pd.DataFrame({"task": [int(pdf["up"].iloc[0])], "n": [float(n.sum())], "weights": [flat.astype("<f4").tobytes()]})

    for round_ in range(rounds):
        flat = network.flat()

        def local(batches, flat=flat, round_=round_):
            import pyarrow as pa
            from pyspark import TaskContext

            docs = (np.frombuffer(b, "<u2").astype(np.int64) for batch in batches for b in batch.column(0).to_pylist())
            own, learnt = _learn(Network.of(flat.copy()), docs, RATE / (1 + round_))
            if learnt:
                yield pa.RecordBatch.from_pydict({"task": pa.array([TaskContext.get().partitionId()], pa.int64()),
                                                  "n": pa.array([float(learnt)]), "weights": [own.flat().astype("<f4").tobytes()]})

        level = written(rows.filter(F.col("round") == round_).select("codes").mapInArrow(local, "task long, n double, weights binary"), f"lm-round-{round_}")
        left = level.count()
        while left > 1:
            left = -(-left // FAN_IN)
            level = level.withColumn("up", F.pmod(F.xxhash64("task"), F.lit(left))).groupBy("up").applyInPandas(
                average, "task long, n double, weights binary")
        got = level.collect()  # one row
        if got:
            network = Network.of(np.frombuffer(got[0]["weights"], "<f4"))
    return network


def score(docs: DataFrame, held_out, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known`` (seen in training),
    ``train_tokens``, ``base_score`` (add-one unigram) and ``score`` (the network),
    both log10 of the whole text's probability, for every row. ``held_out`` is a
    column; rows where it holds are not learnt from.

    Null and empty texts are their end alone. Null keys and repeated rows are
    scored like any other, and counted each time. Without training rows every
    word is unseen. An empty table gives no rows; other columns are not read."""
    spark = prepare(docs.sparkSession)
    encoded = written(_encoded(docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                                           text_of(docs, text).alias("text"))), "lm-encoded", ("kind",), compression="zstd")
    words = encoded.filter("kind = 'word'").select("chunk", "lid", "word", "cnt")
    counted = written(words.groupBy("word").agg(F.sum("cnt").alias("c")), "lm-counts", compression="zstd")
    distinct = counted.filter("c > 0")
    n, v = distinct.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = distinct.filter(F.length("word") > 0).orderBy(F.desc("c"), "word").limit(VOCABULARY - 1).collect()
    vocabulary = [b""] + [bytes(r["word"]) for r in top]
    known = spark.createDataFrame([(w, i) for i, w in enumerate(vocabulary)], "word binary, place int")
    known = F.broadcast(known)  # at most VOCABULARY rows
    ends = distinct.filter(F.length("word") == 0).first()
    masses = np.ones(BUCKETS)  # the words not seen in training share one place in each bucket
    for r in distinct.join(known, "word", "left_anti").groupBy(_bucket(F.col("word")).alias("b")).agg(F.sum(F.col("c") + 1).alias("m")).collect():
        masses[r["b"]] += r["m"]
    share = np.concatenate([[ends["c"] if ends else 0], [r["c"] for r in top], np.zeros(VOCABULARY - len(vocabulary)), masses])
    coded_words = counted.join(known, "word", "left").select(
        "word", "c", F.coalesce("place", F.lit(VOCABULARY) + _bucket(F.col("word"))).cast("int").alias("code"))
    coding = words.select(F.col("chunk").alias("of"), "lid", "word").join(coded_words, "word").select("of", "lid", "c", "code")
    # as many partitions as chunks (each has the empty word): a task's share doesn't grow with the corpus
    chunks = max(words.filter("lid = 0").count(), 1)

    def code(docs, words):
        import pyarrow as pa

        lid = words["lid"].to_numpy()
        c, codes = np.zeros(len(lid), dtype=np.int64), np.zeros(len(lid), dtype=np.int64)
        c[lid], codes[lid] = words["c"].to_numpy(), words["code"].to_numpy()
        base = np.log10((c + 1) / (n + v + 1))
        rest = np.where(codes >= VOCABULARY, np.log10((c + 1) / masses[np.maximum(codes - VOCABULARY, 0)]), 0.0)
        seen, small = (c > 0).astype(np.int64), codes.astype("<u2")
        ids = [np.frombuffer(b, "<u4") for b in docs["ids"].to_pylist()]
        return pa.table({"doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": docs["n_tokens"],
                         "n_known": pa.array([int(seen[i].sum()) for i in ids], pa.int64()),
                         "base_score": pa.array([float(base[i].sum()) for i in ids], pa.float64()),
                         "rest_score": pa.array([float(rest[i].sum()) for i in ids], pa.float64()),
                         "codes": pa.array([small[i].tobytes() for i in ids], pa.binary())})

    ids = encoded.filter("kind = 'doc'").select("chunk", "doc_id", "held_out", "n_tokens", "ids")
    coded = written(ids.repartition(chunks, "chunk").groupBy("chunk").cogroup(
        coding.repartition(chunks, "of").groupBy("of")).applyInArrow(code, CODED), "lm-coded", compression="zstd")
    flat = train(coded, share / share.sum(), rounds).flat()

    def run(batches):
        import pyarrow as pa

        network = Network.of(flat)

        def scored(held):
            lp = network.log_probability([np.frombuffer(b, "<u2") for batch in held for b in batch.column(6).to_pylist()])
            at = 0
            for batch in held:
                total = lp[at:at + batch.num_rows] / math.log(10) + batch.column(5).to_numpy()
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(total)],
                                                 ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

        held, rows, tokens = [], 0, 0
        for batch in batches:
            held.append(batch)
            rows, tokens = rows + batch.num_rows, tokens + sum(batch.column(2).to_pylist())
            if rows >= SCORE_DOCUMENTS or tokens >= SCORE_HELD:
                yield from scored(held)
                held, rows, tokens = [], 0, 0
        yield from scored(held)

    return coded.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double").withColumn(
        "train_tokens", F.lit(n).cast("long"))
