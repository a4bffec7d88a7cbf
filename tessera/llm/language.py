"""Language labels from a bidirectional gated recurrent network over bytes.

Two GRUs read the bytes of a segment forwards and backwards; a softmax over both states labels every byte, and a
document's probabilities are the mean over all its bytes.  The network is trained with numpy by backpropagation
through time on windows of a bounded sample of labelled rows; texts are labelled whole, in segments, on the executors.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

HIDDEN = 8
WINDOW = 48             # bytes of a training window
SEGMENT = 192           # bytes of a labelled segment
UNKNOWN = "und"


def new_model(classes: list[str], hidden: int = HIDDEN, seed: int = 5) -> dict:
    rng = np.random.default_rng(seed)
    model = {"classes": classes, "b": np.zeros((len(classes), 1), np.float32)}
    for way in "fr":
        model[f"x{way}"] = rng.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32)         # input of each byte
        model[f"u{way}"] = rng.normal(0, 0.3, (3 * hidden, hidden)).astype(np.float32)
        model[f"c{way}"] = np.zeros((hidden, 1), np.float32)                                # candidate's recurrent bias
        model[f"o{way}"] = rng.normal(0, 0.3, (len(classes), hidden)).astype(np.float32)
    return model


def _step(x, u, c, h):
    """One GRU step for columns of states: gates (update z, reset r), candidate n and the new state."""
    k = len(h)
    a = u @ h
    g = x[:2 * k] + a[:2 * k]
    g *= 0.5
    np.tanh(g, out=g)
    g *= 0.5
    g += 0.5
    z, r = g[:k], g[k:]
    m = a[2 * k:]
    m += c
    n = r * m
    n += x[2 * k:]
    np.tanh(n, out=n)
    new = h - n
    new *= z
    new += n
    return new, z, r, n, m


def _read(model: dict, way: str, data, steps):
    """States and gates of one direction over ``data`` (bytes x windows), visited in ``steps`` order."""
    h = np.zeros((model[f"u{way}"].shape[1], data.shape[1]), np.float32)
    kept = {}
    for t in steps:
        before = h
        h, z, r, n, m = _step(model[f"x{way}"][:, data[t]], model[f"u{way}"], model[f"c{way}"], h)
        kept[t] = before, h, z, r, n, m
    return kept


def gradients(model: dict, data, label):
    """(loss, gradients): mean cross entropy of every position of ``data`` (bytes x windows), backpropagated through time."""
    steps, windows = data.shape
    kept = {"f": _read(model, "f", data, range(steps)), "r": _read(model, "r", data, range(steps - 1, -1, -1))}
    grad = {k: np.zeros_like(v) for k, v in model.items() if k != "classes"}
    loss, above = 0.0, []
    for t in range(steps):
        logit = model["of"] @ kept["f"][t][1] + model["or"] @ kept["r"][t][1] + model["b"]
        p = np.exp(logit - logit.max(axis=0))
        p /= p.sum(axis=0)
        loss -= np.log(p[label, np.arange(windows)] + 1e-9).sum()
        p[label, np.arange(windows)] -= 1
        p /= steps * windows
        above.append(p)
        grad["b"] += p.sum(axis=1, keepdims=True)
    for way, order in (("f", range(steps - 1, -1, -1)), ("r", range(steps))):
        u, o = model[f"u{way}"], model[f"o{way}"]
        k = u.shape[1]
        dh = np.zeros((k, windows), np.float32)
        for t in order:
            before, h, z, r, n, m = kept[way][t]
            grad[f"o{way}"] += above[t] @ h.T
            dh += o.T @ above[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (before - n) * z * (1 - z)
            dm, dr = dn * r, dn * m * r * (1 - r)
            da = np.concatenate((dz, dr, dm))
            dx = np.concatenate((dz, dr, dn))
            hot = np.zeros((256, windows), np.float32)
            hot[data[t], np.arange(windows)] = 1
            grad[f"x{way}"] += dx @ hot.T
            grad[f"u{way}"] += da @ before.T
            grad[f"c{way}"] += dm.sum(axis=1, keepdims=True)
            dh = dh * z + u.T @ da
    return loss / (steps * windows), grad


def train(texts: list[str], labels: list[str], rounds: int = 110, windows: int = 192, rate: float = 0.02, seed: int = 7) -> dict:
    """A network fitted to windows drawn evenly over the labels (Adam; the same input gives the same network)."""
    classes = sorted(set(labels))
    rng = np.random.default_rng(seed)
    pools = []
    for c in classes:
        raw = np.frombuffer(b" ".join(t.encode() for t, x in zip(texts, labels, strict=True) if x == c) + b" " * WINDOW, np.uint8)
        pools.append(raw)
    model = new_model(classes)
    first = {k: np.zeros_like(v) for k, v in model.items() if k != "classes"}
    second = {k: np.zeros_like(v) for k, v in first.items()}
    for i in range(1, rounds + 1):
        label = rng.integers(0, len(classes), windows)
        data = np.empty((WINDOW, windows), np.uint8)
        for j, c in enumerate(label):
            at = rng.integers(0, len(pools[c]) - WINDOW + 1)
            data[:, j] = pools[c][at:at + WINDOW]
        _, grad = gradients(model, data, label)
        lr = rate * min(1.0, 2 - 2 * i / (rounds + 1))
        for k, g in grad.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            model[k] = (model[k] - lr * (first[k] / (1 - 0.9 ** i)) / (np.sqrt(second[k] / (1 - 0.99 ** i)) + 1e-8)).astype(np.float32)
    return model


def label_segments(model: dict, segments: list[bytes]):
    """Sum over the bytes of each segment of the label probabilities (segments x classes), and nothing else: every
    position is labelled, the sums are what pooling needs."""
    size = np.array([len(s) for s in segments])
    order = np.argsort(-size, kind="stable")
    top = int(size.max(initial=0))
    grid = np.zeros((len(segments), top), np.uint8)
    for row, i in enumerate(order):
        grid[row, :size[i]] = np.frombuffer(segments[i], np.uint8)
    grid = np.ascontiguousarray(grid.T)
    active = np.searchsorted(-size[order], -np.arange(top), side="left")        # segments longer than t
    classes, hidden = len(model["classes"]), model["uf"].shape[1]
    # The byte tables hold all three gates; the output bias goes with the backward pass.
    tables = {w: np.ascontiguousarray(model[f"x{w}"].T) for w in "fr"}
    forward = np.empty((top, classes, len(segments)), np.float32)
    h = np.zeros((hidden, len(segments)), np.float32)
    for t in range(top):
        n = int(active[t])
        h = _step(np.ascontiguousarray(tables["f"][grid[t, :n]].T), model["uf"], model["cf"], h[:, :n])[0]
        forward[t, :, :n] = model["of"] @ h
    out = np.zeros((classes, len(segments)))
    h = np.zeros((hidden, 0), np.float32)
    for t in range(top - 1, -1, -1):
        n = int(active[t])
        if n > h.shape[1]:
            h = np.concatenate((h, np.zeros((hidden, n - h.shape[1]), np.float32)), axis=1)
        h = _step(np.ascontiguousarray(tables["r"][grid[t, :n]].T), model["ur"], model["cr"], h)[0]
        p = forward[t, :, :n] + model["or"] @ h
        p += model["b"]
        np.exp(np.clip(p, -30, 30, out=p), out=p)
        p /= p.sum(axis=0)
        out[:, :n] += p
    back = np.empty_like(out)
    back[:, order] = out
    return back.T


def document_scores(model: dict, texts: list[str], block: int = 3000):
    """Mean label probabilities of each text's bytes (texts x classes)."""
    raw = [t.encode() for t in texts]
    doc = [i for i, r in enumerate(raw) for _ in range(0, len(r), SEGMENT)]
    parts = [r[a:a + SEGMENT] for r in raw for a in range(0, len(r), SEGMENT)]
    total = np.zeros((len(texts), len(model["classes"])))
    for at in range(0, len(parts), block):
        np.add.at(total, doc[at:at + block], label_segments(model, parts[at:at + block]))
    return total / np.maximum(1, [len(r) for r in raw])[:, None]


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id", per_label: int = 300,
        chars: int = 4000) -> dict:
    """A network trained on at most ``per_label`` rows of each label (the rows with the smallest hash of id and text),
    of which the first ``chars`` characters are used.  Rows without a label or text are left out; without any other the
    model has no classes, and ``identify`` finds "und" everywhere."""
    from pyspark.sql import Window

    hashed = (labelled.where(F.col(label_col).isNotNull() & (F.trim(text_col) != ""))
              .select(F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text"),
                      F.xxhash64(F.lit(11), F.col(id_col).cast("string"), text_col).alias("h")))
    place = lambda *order: F.row_number().over(Window.partitionBy("label").orderBy(*order))
    # The hashes alone say where each label's sample ends; texts beyond that are neither sorted nor sent.
    last = (hashed.select("label", "h").withColumn("n", place("h")).where(f"n <= {per_label}")
            .groupBy("label").agg(F.max("h").alias("last")))
    ranked = (hashed.join(F.broadcast(last), "label").where("h <= last").select("label", F.substring("text", 1, chars).alias("text"), "h")
              .withColumn("n", place("h", "text")).where(f"n <= {per_label}"))
    rows = ranked.orderBy("label", "n").select("label", "text").toArrow()
    if not rows.num_rows:
        return {"classes": []}
    return train(rows["text"].to_pylist(), rows["label"].to_pylist())


def identify(docs: DataFrame, model: dict, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(*carry, lang_pred, score): the likeliest label of every whole text and its mean probability over the bytes.

    Null texts and texts without a letter are "und" with score 0.  Ties go to the first label in order.  Repeated rows
    keep a row each; an empty table gives an empty result; only the ``carry`` columns are carried, under their names,
    so others cannot clash."""
    if not model["classes"]:
        return docs.select(*carry, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = docs.select(*carry).schema

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                texts, spoken = part.column(0).to_pylist(), part.column(1).to_pylist()
                p = document_scores(shared.value, [t if s else "" for t, s in zip(texts, spoken, strict=True)])
                best = p.argmax(axis=1)
                pred = [shared.value["classes"][k] if s else UNKNOWN for k, s in zip(best, spoken, strict=True)]
                score = [min(1.0, float(x)) if s else 0.0 for x, s in zip(p[np.arange(len(p)), best], spoken, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[2:], pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                                 names=[*carry, "lang_pred", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spoken = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return (docs.select(F.col(text_col).cast("string").alias("_text"), spoken.alias("_spoken"), *carry)
            .mapInArrow(lean(run), f"{kinds}, lang_pred string, score double"))


def held_out(id_col: str = "doc_id"):
    """The rows kept from learning: those whose crc32 of the id as text is 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
