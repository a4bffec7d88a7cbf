"""Exact n-gram Jaccard self-join through parity sketches.

A document's set holds the hashes of its distinct word n-grams.  Every set size falls in a band; a band's sketch has
``P`` parts, and each element flips the bits of its own 64-bit hash in the one part it falls in (an XOR).  Two sets
that differ in ``D`` elements differ in at most ``D`` parts, so by the pigeonhole principle all but ``D`` of a set's
non-empty parts must agree with any partner's: under one total order of part values, it is enough to join on the first
``D + 1`` of them.  The order puts part values that are frequent in a bounded sample last, so passages that many
documents share rarely become join keys; the sample changes the cost only, never the result.

A candidate pair whose whole bit sketches (one bit per hash bucket, flipped by each element) differ in more bits than
linked sets can differ in elements is dropped; the others are verified exactly.  A part value held by many sets does not emit all its pairs: members are compared
with the smallest one, and only those that fail are compared with the other members, in cells.  A cell returns no more
pairs than it takes to connect the components it holds; where one of them turns out not to be linked, the cell is
compared again without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, key_filter, lean, may_hold, saved

BANDS = 2.0             # ratio of a band's largest to its smallest set
PARTS = 0.6             # parts of a band's sketch for each element of its largest set
SALTS = 3               # sketches of a set with few filled parts, before its empty parts count as a common value
SAMPLE_SETS = 30_000    # documents (about) from which frequent part values are learned
FREQUENT = 6            # a part value is frequent if so many sampled sets hold it
SMALL_BUCKET = 8        # members up to which a part value emits all its pairs
MORE_FORESTS = 8        # growth of the spanning forests a cell returns from one round to the next

_M1, _M2, _MULT = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15


def mix(x):
    """A bijective finaliser of 64-bit hashes (numpy, wraps around)."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(_M1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_M2)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int):
    import numpy as np

    out = np.ones(n, dtype=np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


def shingle_sets(texts: list, words: int):
    """(doc, hash) arrays of the distinct word n-grams of each text, sorted by document and hash; the whole sequence
    is the one element of a shorter text, and a text without words has none.  Words are runs of bytes other than
    ASCII white space, A-Z lower-cased."""
    import numpy as np

    raw = [t.encode() if t else b"" for t in texts]
    buf = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    size = np.array([len(x) + 1 for x in raw], dtype=np.int64)
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    lower = np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)
    edge = np.diff(np.concatenate(([1], space.view(np.int8), [1])))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(begin):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    # Word hash: polynomial of its bytes from prefix sums, then scrambled with its length.
    power = _power(_MULT | 1, len(buf))
    prefix = np.concatenate(([np.uint64(0)], np.cumsum(mix(lower.astype(np.uint64) + np.uint64(1)) * power)))
    inverse = _power(pow(_MULT | 1, -1, 1 << 64), len(buf))
    word = mix((prefix[end] - prefix[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * np.uint64(_M1))
    doc = np.searchsorted(np.cumsum(size), begin, side="right")
    count = np.bincount(doc, minlength=len(raw))
    first = np.cumsum(count) - count
    # n-gram hash: the words in order; a short text has one n-gram of all its words.
    grams = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    gdoc = np.repeat(np.arange(len(raw)), grams)
    at = first[gdoc] + np.arange(len(gdoc)) - np.repeat(np.cumsum(grams) - grams, grams)
    span = np.minimum(count[gdoc], words)
    h = span.astype(np.uint64)
    for k in range(words):
        use = span > k
        h = np.where(use, mix(h * np.uint64(_MULT) + word[np.minimum(at + k, len(word) - 1)]), h)
    order = np.lexsort((h, gdoc))
    gdoc, h = gdoc[order], h[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (gdoc[1:] != gdoc[:-1]) | (h[1:] != h[:-1])
    return gdoc[keep], h[keep]


def set_keys(doc, h, n_docs: int):
    """A 64-bit key of each document's set: equal sets have equal keys."""
    import numpy as np

    count = np.bincount(doc, minlength=n_docs)
    out = mix(count.astype(np.uint64) + np.uint64(_MULT))
    some = np.flatnonzero(count)
    if len(some):
        at = (np.cumsum(count) - count)[some]
        a, b = np.add.reduceat(mix(h ^ np.uint64(_M2)), at), np.bitwise_xor.reduceat(mix(h), at)
        out[some] = mix(out[some] ^ mix(a + np.uint64(3) * b))
    return count, out


def band_of(n):
    """Band number of set sizes (arrays of int >= 1): powers of ``BANDS``."""
    import numpy as np

    return np.floor(np.log(np.maximum(n, 1)) / np.log(BANDS) + 1e-9).astype(np.int64)


def sketch_keys(doc, h, count, percent: int, upper: bool, frequent, salt: int = 0):
    """(doc, key) rows by which a set meets every partner: the first D + 1 non-empty parts of its sketch.

    ``upper``: under the next band's parts, and only for the sets that a partner in that band can have.  A set with no
    more than D filled parts emits them all, so it meets any partner with more; for one that has no more either, both
    emit a second and third sketch, and after those one key for their common empty parts."""
    import numpy as np

    band = band_of(count) + int(upper)
    low = np.ceil(BANDS ** band)
    member = (count > 0) if not upper else (count > 0) & (100 * count >= percent * low)
    parts = np.maximum(2, np.ceil(PARTS * BANDS * low)).astype(np.int64)
    largest = np.floor(100 * count / percent)        # of any partner
    # J >= p: the sets differ in at most (|A| + |B|) (1 - p) / (1 + p) elements.
    differ = np.floor((count + largest) * (100 - percent) / (100 + percent) + 1e-9).astype(np.int64)
    use = member[doc]
    doc, h = doc[use], h[use]
    if not len(doc):
        return doc, h
    part = (mix(h ^ np.uint64(_M1 + salt)) >> np.uint64(33)).astype(np.int64) % parts[doc]
    order = np.argsort(doc * (int(parts.max()) + 1) + part, kind="stable")
    sdoc, part, value = doc[order], part[order], h[order]
    at = np.flatnonzero(np.concatenate(([True], (sdoc[1:] != sdoc[:-1]) | (part[1:] != part[:-1]))))
    value, kdoc, part = np.bitwise_xor.reduceat(value, at), sdoc[at], part[at]
    scheme = (band * SALTS + salt).astype(np.uint64)
    key = mix(value + mix(part.astype(np.uint64) * np.uint64(_MULT) + scheme[kdoc]))
    filled = np.bincount(kdoc, minlength=len(count))
    rank = key >> np.uint64(1)
    if frequent is not None and len(frequent):
        hit = frequent[np.minimum(np.searchsorted(frequent, key), len(frequent) - 1)] == key
        rank = np.where(hit, rank | np.uint64(1 << 63), rank)
    order = np.lexsort((rank, kdoc))
    kdoc, key = kdoc[order], key[order]
    place = np.arange(len(kdoc)) - (np.cumsum(filled) - filled)[kdoc]
    keep = place <= differ[kdoc]
    kdoc, key = kdoc[keep], key[keep]
    poor = member & (filled <= differ)
    if not poor.any():
        return kdoc, key
    if salt + 1 == SALTS:
        rest = np.flatnonzero(poor)
        return np.concatenate((kdoc, rest)), np.concatenate((key, mix(scheme[rest] + np.uint64(_M2))))
    again = poor[doc]
    more = sketch_keys(doc[again], h[again], np.where(poor, count, 0), percent, upper, frequent, salt + 1)
    return np.concatenate((kdoc, more[0])), np.concatenate((key, more[1]))


def bit_sketches(doc, h, count):
    """The parity sketch of each set as bytes: a power of two of bits, at least two for each element."""
    import numpy as np

    bits = np.left_shift(1, np.clip(np.ceil(np.log2(np.maximum(2 * count, 64))), 6, 20).astype(np.int64))
    begin = np.cumsum(bits) - bits
    at = begin[doc] + (mix(h ^ np.uint64(_M2)) >> np.uint64(20)).astype(np.int64) % bits[doc]
    flat = (np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8)
    packed = np.packbits(flat, bitorder="little").tobytes()
    return [packed[x // 8:(x + n) // 8] for x, n in zip(begin.tolist(), bits.tolist(), strict=True)]


def hamming(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded onto the shorter: a lower bound of how many elements
    the sets differ in."""
    import numpy as np

    x, y = (np.frombuffer(v, np.uint64) for v in (a, b))
    n = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, n), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _batches(batches, rows=150):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _all_keys(texts, words, percent, frequent):
    import numpy as np

    doc, h = shingle_sets(texts, words)
    count, key = set_keys(doc, h, len(texts))
    found = [sketch_keys(doc, h, count, percent, upper, frequent) for upper in (False, True)]
    return count, key, bit_sketches(doc, h, count), np.concatenate([d for d, _ in found]), np.concatenate([k for _, k in found])


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                  percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """(sets, links).  ``sets``: one row (id_col, n_shingles, set_key) per input row; rows of equal sets share
    ``set_key``.  ``links``: verified pairs (a, b) of set keys with 100 |A n B| >= percent |A u B| that connect every
    linked pair of sets (pairs already connected through others are left out).

    Null and empty texts, and texts of white space, have empty sets and no links.  Texts of fewer words are one
    n-gram.  Repeated rows and ids keep a row each.  An empty table gives empty results.  Other input columns are not
    carried.
    """
    spark = docs.sparkSession
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))

    def keys_of(frequent):
        def run(batches):
            import numpy as np
            import pyarrow as pa

            done = np.empty(0, np.uint64)       # sets of this task whose keys are out already
            for batch in _batches(batches):
                count, key, bits, doc, part = _all_keys(batch.column(1).to_pylist(), words, percent,
                                                  None if frequent is None else frequent.value)
                first = np.zeros(len(key), dtype=bool)
                first[np.unique(key, return_index=True)[1]] = True
                first &= ~np.isin(key, done) & (count > 0)
                done = np.union1d(done, key[first])
                keep = first[doc]
                doc, part = doc[keep], part[keep]
                spread = mix(key + np.arange(len(key), dtype=np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([batch.column(0), pa.nulls(len(doc), batch.column(0).type)]),
                     pa.array(np.concatenate((count, np.full(len(doc), -1)))),
                     pa.array(np.concatenate((spread, part)).view(np.int64)),
                     pa.array(np.concatenate((key, key[doc])).view(np.int64)),
                     pa.concat_arrays([pa.array(bits, pa.binary()), pa.nulls(len(doc), pa.binary())])],
                    names=["id", "n_shingles", "part_key", "set_key", "bits"])

        return run

    schema = f"id {kind}, n_shingles long, part_key long, set_key long, bits binary"
    share = max(1, texts.count() // SAMPLE_SETS)
    sample = (texts.where(F.pmod(F.xxhash64(F.lit(41), "id", "t"), F.lit(share)) == 0)
              .mapInArrow(lean(keys_of(None)), schema).where("n_shingles < 0").groupBy("part_key").count()
              .where(F.col("count") >= FREQUENT).select("part_key").toArrow())
    frequent = spark.sparkContext.broadcast(_sorted_keys(sample.column(0).to_numpy()))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = saved(texts.mapInArrow(lean(keys_of(frequent)), schema).repartition(n, "part_key")
                  .sortWithinPartitions("part_key", "set_key").mapInArrow(
                      lean(_bucket_pairs), f"id {kind}, n_shingles long, set_key long, bits binary, a long, b long, bucket long"))
    sets = found.where("n_shingles >= 0").select(F.col("id").alias(id_col), "n_shingles", "set_key")
    buckets = found.where("n_shingles < 0").select("a", "b", "bucket")
    bits = found.where("n_shingles > 0").groupBy("set_key").agg(F.max("n_shingles").alias("n"), F.max("bits").alias("bits"))
    pairs = saved(_screened(buckets.select("a", "b").distinct(), bits, percent))
    maybe = pairs.where("ok")
    # Members of large buckets that differ from the bucket's smallest set meet all others of the bucket.
    held = buckets.where("bucket is not null").select("bucket", F.col("b").alias("x"), F.col("a").alias("low"))
    first, body = _settled(texts, maybe, words, percent)
    far = pairs.where("not ok").select("a", "b").unionAll(first.where("not ok").select("a", "b"))
    failed = saved(held.join(far.select(F.col("a").alias("low"), F.col("b").alias("x")), ["low", "x"]).select("bucket", "x").distinct())
    held, links, forests = held.select("bucket", "x"), first.where("ok").select("a", "b"), 1
    while True:
        more = saved(_inside(failed, held, bits, connected_components(links), far, percent, forests))
        if more.isEmpty():
            return sets, links
        settled = _settled(texts, more.select("a", "b").distinct(), words, percent)[0]
        links = links.unionAll(settled.where("ok").select("a", "b"))
        wrong = settled.where("not ok").select("a", "b")
        # A cell whose pairs were all linked, or connected through others, has nothing left to connect.
        again = more.join(wrong, ["a", "b"], "left_semi").select("bucket").distinct()
        failed = saved(failed.join(again, "bucket", "left_semi"))
        if failed.isEmpty():
            return sets, links
        far, forests = far.unionAll(wrong), forests * MORE_FORESTS


def _settled(texts: DataFrame, pairs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(a, b, ok) of enough ``pairs`` (a, b) to connect what they link: each set's pair with its smallest partner first,
    then those whose ends are not connected yet.  Also the texts of the sets in ``pairs``."""
    pairs = pairs.select("a", "b")
    wanted = key_filter(pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct(), "k")
    body = saved(texts.mapInArrow(lean(_bodies(words, wanted)), "set_key long, t string")
                 .groupBy("set_key").agg(F.min("t").alias("t")))
    nearest = saved(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    first = saved(_verified(nearest, body, words, percent))
    rest = saved(_between(pairs.join(nearest, ["a", "b"], "left_anti"), first.where("ok")))
    return first if rest.isEmpty() else first.unionAll(saved(_verified(rest, body, words, percent))), body


def _inside(failed: DataFrame, held: DataFrame, bits: DataFrame, comp: DataFrame, far: DataFrame, percent: int, forests: int,
            block: int = 2048) -> DataFrame:
    """(a, b, bucket): pairs of a failed member (bucket, x) and another member of its bucket that their sketches allow to
    be linked, that are of different components of ``comp`` and not among the pairs ``far``.

    A bucket is compared in cells of at most about ``block`` by ``block`` members.  Of a cell's pairs come out
    ``forests`` spanning forests over its components, so at most ``forests`` times its members; without any, the cell
    has no such pair."""
    mine = failed.withColumn("f", F.lit(True)).unionAll(
        held.join(failed.select("bucket").distinct(), "bucket", "left_semi").distinct().withColumn("f", F.lit(False)))
    side = F.when(F.col("f"), F.col("nf")).otherwise(F.col("nm"))
    other = F.when(F.col("f"), F.col("nm")).otherwise(F.col("nf"))
    count = mine.groupBy("bucket").agg(*[F.ceil(F.count_if(c) / block).cast("int").alias(n)
                                         for c, n in ((F.col("f"), "nf"), (~F.col("f"), "nm"))])
    about = (bits.withColumnRenamed("set_key", "x")
             .join(comp.select(F.col("node").alias("x"), "component"), "x", "left")
             .join(far.groupBy(F.col("b").alias("x")).agg(F.collect_set("a").alias("far")), "x", "left")
             .select("x", "n", "bits", F.coalesce("component", "x").alias("c"), "far"))
    cells = (mine.join(count, "bucket").withColumn("i", F.pmod(F.xxhash64("x"), side).cast("int"))
             .withColumn("j", F.explode(F.sequence(F.lit(0), other - 1)))
             .select("bucket", F.when(F.col("f"), F.col("i")).otherwise(F.col("j")).alias("i"),
                     F.when(F.col("f"), F.col("j")).otherwise(F.col("i")).alias("j"), "f", "x")
             .join(about, "x"))
    n = int(failed.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compare(rows):
        """(a, b) of the forests of one cell's rows (f, x, n, bits, c, far)."""
        import numpy as np

        asked, members = [r for r in rows if r[0]], [r for r in rows if not r[0]]
        tree = {c: i for i, c in enumerate({r[4] for r in rows})}
        if not asked or not members or len(tree) == 1:
            return []
        width = min(len(r[3]) for r in rows) // 8
        fold = lambda rs: np.stack([np.bitwise_xor.reduce(np.frombuffer(r[3], np.uint64).reshape(-1, width), axis=0) for r in rs])
        m, size, of = fold(members), np.array([r[2] for r in members]), np.array([tree[r[4]] for r in members])
        place = {r[1]: k for k, r in enumerate(members)}
        row = {r[1]: k for k, r in enumerate(asked)}
        own = np.array([tree[r[4]] for r in asked])
        # By how much a pair differs less than linked sets may, in sketch bits; below 0 it is no candidate.
        spare = np.empty((len(asked), len(members)), dtype=np.int32)
        for at in range(0, len(asked), 64):
            part = asked[at:at + 64]
            q, mine = fold(part), np.array([r[2] for r in part])[:, None]
            differ = sum(np.bitwise_count(q[:, k:k + 1] ^ m[None, :, k]).astype(np.int64) for k in range(width))
            room = (100 - percent) * (mine + size) - (100 + percent) * differ
            room[100 * np.minimum(mine, size) < percent * np.maximum(mine, size)] = -1
            room[own[at:at + 64, None] == of] = -1
            spare[at:at + 64] = room
        for r in rows:
            for a in r[5] or ():
                if r[0] and a in place:
                    spare[row[r[1]], place[a]] = -1
                elif not r[0] and a in row:
                    spare[row[a], place[r[1]]] = -1
        out, some = set(), np.flatnonzero((spare >= 0).any(axis=1))
        for _ in range(forests):
            root, found = np.arange(len(tree)), []
            for i in some.tolist():
                ok = np.flatnonzero(spare[i] >= 0)
                trees = root[of[ok]]
                ok, trees = ok[trees != root[own[i]]], trees[trees != root[own[i]]]
                if not len(ok):
                    continue
                best = np.lexsort((-spare[i, ok], trees))
                best = best[np.concatenate(([True], np.diff(trees[best]) != 0))]
                found.extend((i, k) for k in ok[best].tolist())
                root[np.isin(root, trees)] = root[own[i]]
            if not found:
                break
            for i, k in found:
                a, b = asked[i][1], members[k][1]
                out.add((min(a, b), max(a, b)))
                spare[i, k] = -1
                if a in place and b in row:
                    spare[row[b], place[a]] = -1
        return sorted(out)

    def run(batches):
        import pyarrow as pa

        cell, rows = None, []

        def out(pairs):
            cols = [[p[k] for p in pairs] for k in range(3)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "bucket"])

        def close():
            return [(a, b, cell[0]) for a, b in compare(rows)] if rows else []

        for batch in batches:
            found = []
            for *key, f, x, size, sketch, c, no in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != cell:
                    found += close()
                    cell, rows = key, []
                rows.append((f, x, size, sketch, c, no))
            yield out(found)
        yield out(close())

    return (cells.repartition(n, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
            .select("bucket", "i", "j", "f", "x", "n", "bits", "c", "far")
            .mapInArrow(lean(run), "a long, b long, bucket long"))


def _screened(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """(a, b, ok): whether the sketches allow each pair to be linked."""
    side = lambda c: bits.select(F.col("set_key").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"s{c}"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            na, sa, nb, sb = (batch.column(i).to_pylist() for i in range(2, 6))
            ok = [100 * min(m, n) >= percent * max(m, n) and (100 + percent) * hamming(x, y) <= (100 - percent) * (m + n)
                  for m, x, n, y in zip(na, sa, nb, sb, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "sa", "nb", "sb")
            .mapInArrow(lean(run), "a long, b long, ok boolean"))


def _sorted_keys(keys):
    import numpy as np

    return np.sort(keys.astype(np.int64).view(np.uint64))


def _bodies(words, wanted):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in _batches(batches):
            doc, h = shingle_sets(batch.column(1).to_pylist(), words)
            count, key = set_keys(doc, h, len(batch))
            keep = may_hold(wanted.value, key.view(np.int64)) & (count > 0)
            keep &= np.isin(np.arange(len(key)), np.unique(key, return_index=True)[1])
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)).take(at), batch.column(1).take(at)],
                                             names=["set_key", "t"])

    return run


def _bucket_pairs(batches):
    """Pairs of the sets that hold one part value; rows arrive sorted by (part_key, set_key).  Up to SMALL_BUCKET
    members emit all their pairs.  A larger bucket emits (smallest, member), with its key so that failures can come
    back to it.  Only a bucket's first members are held, so memory does not grow with a bucket."""
    import numpy as np
    import pyarrow as pa

    key, head, size, last = None, [], 0, None
    a, b, c = [], [], []

    def close():
        if 1 < size <= SMALL_BUCKET:
            for i in range(size):
                a.extend([head[i]] * (size - i - 1))
                b.extend(head[i + 1:])
                c.extend([None] * (size - i - 1))

    def large(x):
        a.extend((head[0], head[0]))
        b.extend((x, x))
        c.extend((None, key))

    def flush():
        # the same pair comes from many parts: once for each task and flush is enough
        rows = set(zip(a, b, c, strict=True))
        a.clear(), b.clear(), c.clear()
        cols = zip(*rows, strict=True) if rows else ([], [], [])
        x, y, z = (pa.array(v, pa.int64()) for v in cols)
        return pa.RecordBatch.from_arrays([pa.nulls(len(x), kind), pa.array(np.full(len(x), -1)), pa.nulls(len(x), pa.int64()),
                                           pa.nulls(len(x), pa.binary()), x, y, z], names=names)

    names, kind = ["id", "n_shingles", "set_key", "bits", "a", "b", "bucket"], None
    for batch in batches:
        kind = batch.column(0).type
        is_set = batch.column(1).to_numpy() >= 0
        at = pa.array(np.flatnonzero(is_set))
        no = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), batch.column(3).take(at),
                                           batch.column(4).take(at), no, no, no],
                                         names=names)
        k, s = batch.column(2).to_numpy()[~is_set], batch.column(3).to_numpy()[~is_set]
        if not len(k):
            continue
        same = np.zeros(len(k), dtype=bool)
        same[1:] = k[1:] == k[:-1]
        # only rows that share their key with a neighbour, or touch the batch's ends, can matter
        touch = same.copy()
        touch[:-1] |= same[1:]
        touch[0] = touch[-1] = True
        for ki, si in zip(k[touch].tolist(), s[touch].tolist(), strict=True):
            if ki != key:
                close()
                key, head, size, last = ki, [si], 1, si
            elif si != last:
                last, size = si, size + 1
                if size <= SMALL_BUCKET:
                    head.append(si)
                else:
                    if size == SMALL_BUCKET + 1:
                        for x in head[1:]:
                            large(x)
                    large(si)
        if len(a) > 100_000:
            yield flush()
    close()
    if a:
        yield flush()


def _between(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """The pairs whose ends ``links`` does not connect yet."""
    comp = connected_components(links)
    of = lambda side: comp.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
    return (pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
            .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))


def _verified(pairs: DataFrame, body: DataFrame, words: int, percent: int, block: int = 500) -> DataFrame:
    """(a, b, ok) for each pair: the exact test of the two sets.  A set's partners are dealt in blocks, each with one
    copy of its text, so a set with very many partners spans many tasks."""
    blocks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("n"))
    right = (pairs.join(blocks, "a").join(body.withColumnRenamed("set_key", "b"), "b")
             .select("a", F.pmod(F.xxhash64("b"), F.col("n")).cast("int").alias("s"), F.col("b"), "t"))
    left = (blocks.join(body.withColumnRenamed("set_key", "a"), "a")
            .select("a", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("s"), F.lit(None).cast("long").alias("b"), "t"))
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        own = np.empty(0, np.uint64)
        for batch in _batches(batches, 300):
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            doc, h = shingle_sets(batch.column(2).to_pylist(), words)
            cut = np.searchsorted(doc, np.arange(len(a) + 1))
            out = []
            for i, (x, y) in enumerate(zip(a, b, strict=True)):
                other = h[cut[i]:cut[i + 1]]
                if y is None:
                    own = other
                    continue
                at = np.searchsorted(own, other)
                both = int((own[np.minimum(at, len(own) - 1)] == other).sum()) if len(own) else 0
                out.append((x, y, 100 * both >= percent * (len(own) + len(other) - both)))
            cols = list(zip(*out, strict=True)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.bool_())], names=["a", "b", "ok"])

    return (right.unionByName(left).repartition(n, "a", "s").sortWithinPartitions("a", "s", F.col("b").asc_nulls_first())
            .select("a", "b", "t").mapInArrow(lean(run), "a long, b long, ok boolean"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                percent: int = 75) -> DataFrame:
    """(id_col, n_shingles, component_id): the smallest id that links lead to from each document, itself included.

    Equal non-empty sets are linked.  See ``jaccard_links`` for nulls, short texts and ties; a null id takes part
    like any other but is never the smallest of a group that has another."""
    sets, links = jaccard_links(docs, id_col, text_col, words, percent)
    comp = connected_components(links)
    groups = (sets.where("n_shingles > 0").groupBy("set_key").agg(F.min(id_col).alias("low"))
              .join(comp.withColumnRenamed("node", "set_key"), "set_key", "left")
              .select("set_key", F.coalesce("component", "set_key").alias("g"), "low"))
    low = groups.groupBy("g").agg(F.min("low").alias("component_id"))
    of = groups.join(low, "g").select("set_key", "component_id")
    return (sets.join(of, "set_key", "left")
            .select(id_col, "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component_id", id_col))
                    .otherwise(F.col(id_col)).alias("component_id")))
