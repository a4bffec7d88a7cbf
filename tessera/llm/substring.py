"""Exact removal of repeated substrings, with hash-compared suffix sorting.

A byte goes if a string of ``length`` bytes that covers it also starts earlier (smaller id, or same document and
earlier start).  Strings never cross documents and are judged on the input.

1. Every string of ``length`` bytes holds ``length - GRAM + 1`` grams; the one of least hash is its anchor, so equal
   strings have equal anchors at equal offsets.  Each task finds its documents' anchors from prefix polynomial hashes
   and sliding minima.  An anchor's context is all bytes of the strings that may hold it.  Where anchor and context
   are equal (a class), all but the first are repeats as a whole; a task sends only the first of its own.
2. Anchors are dealt by gram.  Rows arrive sorted, so classes are told apart in a stream of constant memory.  Only the
   first of each class, and only of grams with more than one class, needs its bytes.
3. Those contexts are cut out of their documents once and dealt by gram.  Two equal strings share the anchor and half of
   the rest before it or half of the rest after it, so only strings whose half occurs again are looked at.  Within a part
   of a task they are sorted as suffixes by mergesort (two suffixes compare by their longest common extension, found by
   binary search over prefix hashes; equal ones are checked byte by byte).  Strings whose hash occurs in several parts
   are dealt by it, sorted, and compared byte by byte in a stream.

No task holds all contexts of a gram or all copies of a string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.common import ordinal_within
from .common import key_filter, lean, may_hold, saved

GRAM = 32
FLUSH = 300_000         # anchors a task holds before it sends the firsts of their classes
SORT_CONTEXTS = 6000    # contexts of one sort
BASE = 0x9E3779B97F4A7C15

_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


class PrefixHash:
    """Polynomial hashes (mod 2**64) of any substring of ``buf`` in constant time."""

    def __init__(self, buf, base: int = BASE):
        import numpy as np

        def powers(x):
            out = np.full(len(buf) + 1, x, dtype=np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        value = _mix(np.arange(256, dtype=np.uint64) + np.uint64(base & 0xFFFF))
        self.prefix = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum(value[buf] * powers(base)[:-1], out=self.prefix[1:])
        self.inverse = powers(pow(base, -1, 1 << 64))

    def of(self, start, stop):
        return (self.prefix[stop] - self.prefix[start]) * self.inverse[start]


def _sliding(x, w: int, low: bool):
    """Minimum (or maximum) of x[i : i + w] for every i with a whole window."""
    import numpy as np

    f = np.minimum if low else np.maximum
    n = -(-len(x) // w) * w
    y = np.full(n, np.iinfo(np.uint64).max if low else 0, dtype=np.uint64)
    y[:len(x)] = x
    y = y.reshape(-1, w)
    head = f.accumulate(y, axis=1).ravel()
    tail = f.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    m = len(x) - w + 1
    return f(tail[:m], head[w - 1:w - 1 + m])


def anchors(texts: list[bytes], length: int):
    """(doc, start, right, gram, context) arrays: anchors of all strings of ``length`` bytes; ``right`` is the
    number of context bytes from the anchor on."""
    import numpy as np

    size = np.array([len(t) for t in texts], dtype=np.int64)
    begin = np.cumsum(size) - size
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if size.max(initial=0) < length:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    w = length - GRAM + 1
    h = PrefixHash(buf)
    at = np.arange(len(buf) - GRAM + 1)
    gram = _mix(h.of(at, at + GRAM))
    least = _sliding(gram, w, True)
    # Only windows inside one document count.
    edge = np.zeros(len(least) + 1, dtype=np.int64)
    some = size >= length
    np.add.at(edge, begin[some], 1)
    np.add.at(edge, np.minimum(begin + size - length + 1, len(least))[some], -1)
    least[np.cumsum(edge[:-1]) == 0] = 0
    # An anchor is the least gram of a window that holds it: the largest of these minima is the gram itself.
    pad = np.zeros(w - 1, dtype=np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate((pad, least, pad)), w, False)[:len(gram)] == gram)
    at = at[gram[at] > 0]
    doc = np.searchsorted(begin + size, at, side="right")
    start = at - begin[doc]
    left, right = np.minimum(start, w - 1), np.minimum(size[doc] - start, length)
    context = _mix(h.of(at - left, at + right) + (left * 4096 + right).astype(np.uint64))
    return doc, start, right, gram[at], context


def merged(start, stop, group):
    """Overlapping or touching intervals of the same group as one; sorted by (group, start)."""
    import numpy as np

    order = np.lexsort((start, group))
    start, stop, group = start[order], stop[order], group[order]
    if not len(start):
        return start, stop, group
    new = np.concatenate(([True], group[1:] != group[:-1]))
    # A running maximum of the ends within each group: groups are shifted apart.
    shift = np.cumsum(new) * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + shift)
    new[1:] |= start[1:] + shift[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.concatenate((at[1:], [len(start)])) - 1
    return start[at], (reach - shift)[last], group[at]


def suffix_sort(h: PrefixHash, buf, start, group, length: int):
    """Order of the suffixes by (group, first ``length`` bytes), stable, and whether each has the bytes of the one
    before it.  ``group`` is sorted.  Runs of all groups are merged level by level; a suffix's place in the other run
    is found by binary search with ``common`` extensions as comparison."""
    import numpy as np

    def common(a, b):
        low, high = np.zeros(len(a), np.int64), np.full(len(a), length)
        while (live := low < high).any():
            mid = (low + high + 1) // 2
            same = h.of(a, a + mid) == h.of(b, b + mid)
            low, high = np.where(live & same, mid, low), np.where(live & ~same, mid - 1, high)
        return low

    n = len(start)
    new = np.concatenate(([True], group[1:] != group[:-1])) if n else np.empty(0, bool)
    first = np.flatnonzero(new)
    size = np.diff(np.concatenate((first, [n])))
    first, size = np.repeat(first, size), np.repeat(size, size)
    order, width = np.arange(n), 1
    while width < size.max(initial=0):
        place = np.arange(n) - first
        run = place // width
        other = first + (run ^ 1) * width
        held = np.clip(size - (run ^ 1) * width, 0, width)
        low, high = np.zeros(n, np.int64), held.copy()
        live = np.flatnonzero(low < high)
        while len(live):
            mid = (low[live] + high[live]) // 2
            a, b = start[order[live]], start[order[other[live] + mid]]
            ext = common(a, b)
            equal = ext == length
            a, b = buf[a + np.minimum(ext, length - 1)], buf[b + np.minimum(ext, length - 1)]
            before = np.where(equal, (run[live] & 1) == 1, b < a)       # the other one stands before this one
            low[live] = np.where(before, mid + 1, low[live])
            high[live] = np.where(before, high[live], mid)
            live = live[low[live] < high[live]]
        moved = np.empty(n, dtype=np.int64)
        moved[first + (run & ~1) * width + place - run * width + low] = order
        order, width = moved, 2 * width
    same = np.zeros(n, dtype=bool)
    if n > 1:
        inner = np.flatnonzero(~new)
        same[inner] = common(start[order[inner]], start[order[inner - 1]]) == length
    return order, same


def strings(contexts: list[bytes], left, length: int):
    """(buf, at, context, offset, mark): every string of ``length`` bytes whose least gram the anchor of its context is,
    ``offset`` before it; ``at`` are the anchors' places in ``buf``; equal strings have equal marks."""
    import numpy as np

    buf = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    size = np.array([len(x) for x in contexts], dtype=np.int64)
    begin = np.cumsum(size) - size
    at = begin + left
    w, h = length - GRAM + 1, PrefixHash(buf)
    # Only the strings whose least gram the anchor is: those that reach no smaller gram on either side.
    i = np.arange(len(buf) - GRAM + 1)
    value = _mix(h.of(i, i + GRAM))

    def reach(step):
        """Distance to the nearest smaller gram in the context (w if there is none)."""
        place = at[:, None] + step * np.arange(1, w)
        inside = (place >= begin[:, None]) & (place + GRAM <= (begin + size)[:, None])
        less = (value[np.clip(place, 0, len(value) - 1)] < value[at][:, None]) & inside
        return np.where(less.any(axis=1), less.argmax(axis=1) + 1, w)

    low = np.maximum(np.maximum(0, length - (size - left)), w - reach(1))
    count = np.maximum(0, np.minimum(left, reach(-1) - 1) - low + 1)
    ctx = np.repeat(np.arange(len(size)), count)
    offset = low[ctx] + np.arange(len(ctx)) - np.repeat(np.cumsum(count) - count, count)
    start = at[ctx] - offset
    return buf, at, ctx, offset, _mix(h.of(start, start + length) + (offset * 2 + 1).astype(np.uint64))


def repeats(contexts: list[bytes], left, gram, length: int, found=None):
    """(context, offset) of every string of ``length`` bytes, ``offset`` before its anchor, that an earlier context of
    the same gram has at the same offset; contexts are given in their order within a gram, grams together."""
    import numpy as np

    buf, at, ctx, offset, mark = found or strings(contexts, left, length)
    own, w = np.concatenate(([0], np.cumsum(gram[1:] != gram[:-1]))), length - GRAM + 1
    # Equal strings have equal hashes: others need no sorting.
    order = np.argsort(mark, kind="stable")
    twin = mark[order][1:] == mark[order][:-1]
    many = np.zeros(len(ctx), dtype=bool)
    many[order[1:]] = twin
    many[order[:-1]] |= twin
    ctx, offset = ctx[many], offset[many]
    order = np.argsort(own[ctx] * w + offset, kind="stable")
    ctx, offset = ctx[order], offset[order]
    group, start = own[ctx] * w + offset, at[ctx] - offset
    base = BASE
    while True:
        order, same = suffix_sort(PrefixHash(buf, base), buf, start, group, length)
        hit = np.flatnonzero(same)
        a, b, span = start[order[hit]], start[order[hit - 1]], np.arange(length)
        if all((buf[a[i:i + 4096, None] + span] == buf[b[i:i + 4096, None] + span]).all()
               for i in range(0, len(hit), 4096)):
            return ctx[order[hit]], offset[order[hit]]
        base = base * 5 + 2 | 1         # a collision: sort again with other hashes


def _first_of_classes(length):
    """Task of step 1: (gram, context, doc, at, start, stop); ``at`` holds start and right.  Repeats inside the task
    come out as intervals (gram null)."""
    w = length - GRAM + 1

    def out(gram, context, doc, at, rdoc, start, stop):
        import numpy as np
        import pyarrow as pa

        n, m = len(doc), len(rdoc)
        no, none = pa.nulls(n, pa.int64()), pa.nulls(m, pa.int64())
        spread = pa.array(_mix(rdoc.view(np.uint64)).view(np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(gram.view(np.int64)), spread]), pa.concat_arrays([pa.array(context.view(np.int64)), none]),
             pa.array(np.concatenate((doc, rdoc))), pa.concat_arrays([pa.array(at), none]),
             pa.concat_arrays([no, pa.array(start)]), pa.concat_arrays([no, pa.array(stop)])],
            names=["gram", "context", "doc", "at", "start", "stop"])

    def flush(held):
        import numpy as np

        doc, start, right, gram, context = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((start, doc, context, gram))
        doc, start, right, gram, context = (x[order] for x in (doc, start, right, gram, context))
        again = np.zeros(len(doc), dtype=bool)
        again[1:] = (gram[1:] == gram[:-1]) & (context[1:] == context[:-1])
        s, e, d = merged((start - np.minimum(start, w - 1))[again], (start + right)[again], doc[again])
        one = ~again
        return out(gram[one], context[one], doc[one], (start * 4096 + right)[one], d, s, e)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 300):
                part = batch.slice(at, 300)
                keys = part.column(0).to_numpy()
                doc, *rest = anchors([(t or "").encode() for t in part.column(1).to_pylist()], length)
                held.append((keys[doc], *rest))
                n += len(doc)
                if n > FLUSH:
                    yield flush(held)
                    held, n = [], 0
        if held:
            yield flush(held)

    return run


def _classes(length):
    """Task of step 2, over rows sorted by (gram, context, doc, at): the repeats of whole contexts as intervals, and
    the first of each class of a gram with several classes (with its gram)."""
    w = length - GRAM + 1

    def run(batches):
        import numpy as np
        import pyarrow as pa

        last, waiting, several = None, None, False      # of the rows before: (gram, context); a class not yet sent
        for batch in batches:
            gram, doc, start, stop = (batch.column(i) for i in (0, 2, 4, 5))
            given = start.is_valid().to_numpy(zero_copy_only=False)
            keep = pa.array(np.flatnonzero(given))
            done = [[doc.take(keep).to_numpy(), start.take(keep).to_numpy(), stop.take(keep).to_numpy()]]
            g, c, d, at = (batch.column(i).filter(pa.array(~given)).to_numpy() for i in range(4))
            sent = [np.empty(0, np.int64)] * 3
            if len(g):
                same_g, same_c = np.zeros(len(g), bool), np.zeros(len(g), bool)
                same_g[1:] = g[1:] == g[:-1]
                same_c[1:] = same_g[1:] & (c[1:] == c[:-1])
                if last is not None:
                    same_g[0] = g[0] == last[0]
                    same_c[0] = same_g[0] and c[0] == last[1]
                pos, right = at >> 12, at & 4095
                done.append([d[same_c], (pos - np.minimum(pos, w - 1))[same_c], (pos + right)[same_c]])
                last = (g[-1], c[-1])
                one = ~same_c
                fg, fd, fa = g[one], d[one], at[one]
                if len(fg):
                    carried = waiting is not None and waiting[0] == fg[0]
                    if carried:
                        fg, fd, fa = (np.concatenate(([x], y)) for x, y in zip(waiting, (fg, fd, fa), strict=True))
                    joined = np.zeros(len(fg), dtype=bool)
                    joined[1:] = fg[1:] == fg[:-1]
                    joined[0] = several is not False and several == fg[0] and not carried
                    multi = joined.copy()
                    multi[:-1] |= joined[1:]
                    sent = [fg[multi], fd[multi], fa[multi]]
                    waiting = None if multi[-1] else (fg[-1], fd[-1], fa[-1])
                    several = fg[-1] if multi[-1] else False
            d0, s0, e0 = (np.concatenate(x) for x in zip(*done, strict=True))
            s0, e0, d0 = merged(s0, e0, d0)
            n, m = len(d0), len(sent[0])
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(sent[0])]), pa.array(np.concatenate((d0, sent[1]))),
                 pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(sent[2])]),
                 pa.concat_arrays([pa.array(s0), pa.nulls(m, pa.int64())]), pa.concat_arrays([pa.array(e0), pa.nulls(m, pa.int64())])],
                names=["gram", "doc", "at", "start", "stop"])

    return run


def _contexts(length):
    """Cuts the contexts of the wanted anchors out of documents (doc, t, rows): (gram, doc, pos, before, after, context),
    with hashes of the anchor and the bytes of half a string's rest before and after it (null over a document's edge)."""
    w, half = length - GRAM + 1, (length - GRAM) // 2

    def cut(docs, texts, rows):
        import numpy as np
        import pyarrow as pa

        doc, gram, at, found = [], [], [], []
        for d, t, wanted in zip(docs, texts, rows, strict=True):
            raw = t.encode()
            for r in wanted:
                p, right = r["at"] >> 12, r["at"] & 4095
                doc.append(d)
                gram.append(r["gram"])
                at.append(p)
                found.append(raw[max(0, p - w + 1):p + right])
        pos, size = np.array(at, dtype=np.int64), np.array([len(x) for x in found], dtype=np.int64)
        h, left = PrefixHash(np.frombuffer(b"".join(found), dtype=np.uint8)), np.minimum(pos, w - 1)
        begin = np.cumsum(size) - size
        place, stop = begin + left, begin + size
        low, high = np.maximum(place - half, 0), np.minimum(place + GRAM + half, stop)
        before = _mix(h.of(low, place + GRAM) + np.uint64(1)).view(np.int64)
        after = _mix(h.of(place, high) + np.uint64(2)).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(gram, pa.int64()), pa.array(doc, pa.int64()), pa.array(pos), pa.array(before, mask=left < half),
             pa.array(after, mask=place + GRAM + half > stop), pa.array(found, pa.binary())],
            names=["gram", "doc", "pos", "before", "after", "context"])

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 300):
                yield cut(*(batch.column(k).slice(i, 300).to_pylist() for k in range(3)))

    return run


def _blocks(buf, at, ctx, offset, mark, group, length: int):
    """Which strings stand in a block that an earlier context of the same group has byte for byte.  A block is a context's
    strings of up to 8 neighbouring offsets; contexts are in their order within a group.  What differs in one string
    is left to the sort."""
    import numpy as np

    if not len(ctx):
        return np.zeros(0, dtype=bool)
    key = ctx * 512 + offset // 8
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.concatenate((first, [len(ctx)])))
    code = np.add.reduceat(_mix(mark), first) + _mix(size.astype(np.uint64))
    own = group[ctx[first]]
    order = np.lexsort((np.arange(len(first)), code, own))
    same = (code[order][1:] == code[order][:-1]) & (own[order][1:] == own[order][:-1])
    lead = np.concatenate(([True], ~same))
    earlier = np.empty(len(first), dtype=np.int64)
    earlier[order] = order[np.flatnonzero(lead)][np.cumsum(lead) - 1]
    again = np.flatnonzero(earlier != np.arange(len(first)))
    # Offsets ascend within a block, so its bytes run from its last string's start to its first string's end.
    low = at[ctx] - offset
    start, other, span = low[(first + size - 1)[again]], low[(first + size - 1)[earlier[again]]], length + size[again] - 1
    equal = size[again] == size[earlier[again]]
    step = np.arange(length + 8)
    for i in range(0, len(again), 4096):
        c = slice(i, i + 4096)
        place = np.minimum(step, span[c, None] - 1)
        equal[c] &= (buf[np.minimum(start[c, None] + place, len(buf) - 1)] == buf[np.minimum(other[c, None] + place, len(buf) - 1)]).all(axis=1)
    hit = np.zeros(len(first), dtype=bool)
    hit[again[equal]] = True
    return np.repeat(hit, size)


def _strings(length, halves, bitmap=None):
    """The strings of contexts (gram, doc, pos, before, after, context), in parts of about SORT_CONTEXTS contexts; ``halves``
    is the bitmap of the hashes before and after that occur again.  Without a bitmap the marks of each part, once, and
    what has an equal earlier string in its part, as intervals: (mark, doc, start, stop).  With the bitmap of marks that
    occur in several parts the first string of each of these in its part: (block, mark, doc, start, bytes); neighbouring
    strings of a gram share their block, so what a task finds of them leaves it as few intervals."""
    w, half = length - GRAM + 1, (length - GRAM) // 2

    def part(batch):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def again(k):
            keys = batch.column(k)
            return may_hold(halves.value, keys.fill_null(0).to_numpy()) & keys.is_valid().to_numpy(zero_copy_only=False)

        batch = batch.filter(pa.array(again(3) | again(4)))
        if not batch.num_rows:
            return None
        batch = batch.take(pc.sort_indices(pa.Table.from_batches([batch]).select(["gram", "doc", "pos"]),
                                           [("gram", "ascending"), ("doc", "ascending"), ("pos", "ascending")]))
        gram, doc, pos = (batch.column(i).to_numpy() for i in range(3))
        contexts, left = batch.column(5).to_pylist(), np.minimum(pos, w - 1)
        buf, at, ctx, offset, mark = strings(contexts, left, length)
        # A string that starts half a rest before its anchor shares the bytes before it with its equals, others those after.
        some = np.where(offset >= half, again(3)[ctx], again(4)[ctx])
        if bitmap is not None:
            some &= may_hold(bitmap.value, mark.view(np.int64))
        ctx, offset, mark = ctx[some], offset[some], mark[some]
        if bitmap is not None:      # equal marks have one gram, so the first of them is the earliest string
            _, one = np.unique(mark, return_index=True)
            start = at[ctx[one]] - offset[one]
            raw = buf.tobytes()
            block = _mix(gram[ctx[one]].view(np.uint64) + (offset[one] // 32).astype(np.uint64))
            return pa.RecordBatch.from_arrays(
                [pa.array(block.view(np.int64)), pa.array(mark[one].view(np.int64)), pa.array(doc[ctx[one]]), pa.array(pos[ctx[one]] - offset[one]),
                 pa.array([raw[x:x + length] for x in start.tolist()], pa.binary())], names=["block", "mark", "doc", "start", "bytes"])
        held = _blocks(buf, at, ctx, offset, mark, gram, length)
        new = ~held
        rctx, roffset = repeats(contexts, left, gram, length, (buf, at, ctx[new], offset[new], mark[new]))
        rdoc, start = (np.concatenate((x, y)) for x, y in ((doc[ctx[held]], doc[rctx]), (pos[ctx[held]] - offset[held], pos[rctx] - roffset)))
        s, e, d = merged(start, start + length, rdoc)
        marks = np.unique(mark[new]).view(np.int64)
        n, m = pa.nulls(len(marks), pa.int64()), pa.nulls(len(d), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(marks), m]), *(pa.concat_arrays([n, pa.array(x)]) for x in (d, s, e))],
            names=["mark", "doc", "start", "stop"])

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, SORT_CONTEXTS):
                if (out := part(batch.slice(i, SORT_CONTEXTS))) is not None:
                    yield out

    return run


def _later(length):
    """Task of step 3, over strings sorted by (block, mark, doc, start): those whose bytes an earlier one has, as intervals."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        last, seen = None, set()
        for batch in batches:
            hit = np.zeros(batch.num_rows, dtype=bool)
            for i, (mark, raw) in enumerate(zip(batch.column(1).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                if mark != last:
                    last, seen = mark, set()
                hit[i] = raw in seen
                seen.add(raw)
            at = np.flatnonzero(hit)
            doc, start = (batch.column(i).to_numpy()[at] for i in (2, 3))
            s, e, d = merged(start, start + length, doc)
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(s), pa.array(e)], names=["doc", "start", "stop"])

    return run


def _apply(output):
    """Removes each document's merged intervals (last column) from its bytes."""
    def cut(batch):
        import pyarrow as pa

        spans, kept, size = [], [], []
        for text, found in zip(batch.column(1).to_pylist(), batch.columns[-1].to_pylist(), strict=True):
            raw = (text or "").encode()
            size.append(len(raw))
            runs: list[list[int]] = []
            for x, y in sorted((x["start"], x["stop"]) for x in found or ()):
                if runs and x <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], y)
                else:
                    runs.append([x, y])
            spans.append([{"start": x, "stop": y} for x, y in runs])
            edges = zip([0, *(y for _, y in runs)], [*(x for x, _ in runs), len(raw)], strict=True)
            kept.append(b"".join(raw[x:y] for x, y in edges) if runs else raw)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
             pa.array(kept, pa.binary()), *batch.columns[2:-1]], names=output)

    def run(batches):
        for batch in batches:       # in small parts: a batch's texts stand in memory several times
            for i in range(0, batch.num_rows, 300):
                yield cut(batch.slice(i, 300))

    return run


def _where(bitmap, wanted: bool):
    """Rows whose key (column 0) the bitmap may hold, or the others."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            hit = may_hold(bitmap.value, batch.column(0).to_numpy())
            yield batch.filter(pa.array(hit == wanted))

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, n_bytes, spans array<struct<start, stop>>, kept binary, *carry) for each row: the maximal removed runs of
    bytes and the remaining bytes.

    Null and empty texts, and texts of fewer than ``length`` bytes, lose nothing.  Ids give the order of documents; a
    null id comes before all others; of rows with one id, equal texts are the same document (neither is earlier) and
    others are ordered by a hash of their text.  An empty table gives an empty result; columns other than ``carry`` are
    not carried, so their names cannot clash.
    """
    spark = docs.sparkSession
    if not GRAM < length < 4096:
        raise ValueError(f"length must be above {GRAM} and below 4096")
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    more = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    extra = [f"c{i}" for i in range(len(carry))]
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"), *more)
    plain = base.agg(F.count(F.lit(1)) == F.count("id")).first()[0] and not base.groupBy("id").count().where(
        "count > 1").limit(1).count()
    if kind in ("bigint", "int", "smallint", "tinyint") and plain:
        base = base.select(F.col("id"), F.col("id").cast("long").alias("doc"), "t", *extra)
    else:
        names = ordinal_within(base.select("id", F.xxhash64("t").alias("h")).distinct(), [], ["id", "h"], "doc")
        same = F.col("l.id").eqNullSafe(F.col("r.id")) & (F.xxhash64(F.col("l.t")) == F.col("r.h"))
        base = saved(base.alias("l").join(names.alias("r"), same).select("l.id", F.col("r.doc").cast("long").alias("doc"), "l.t", *[f"l.{c}" for c in extra]))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    span = "start long, stop long"
    found = saved(base.select("doc", "t").mapInArrow(lean(_first_of_classes(length)), f"gram long, context long, doc long, at long, {span}")
                  .repartition(n, "gram").sortWithinPartitions("gram", "context", "doc", "at")
                  .mapInArrow(lean(_classes(length)), f"gram long, doc long, at long, {span}"))
    whole = found.where("start is not null").select("doc", "start", "stop")
    wanted = found.where("gram is not null").select("doc", "gram", "at")
    hashed = base.select(F.xxhash64("doc").alias("k"), "id", "doc", "t", *extra)
    some = hashed.mapInArrow(lean(_where(key_filter(wanted.select(F.xxhash64("doc").alias("k")).distinct(), "k"), True)), hashed.schema)
    # Repeated rows of one document count once; ids that differ need no exchange for it.
    texts = some.select("doc", "t") if plain else some.select("doc", "t").dropDuplicates(["doc"])
    # Dealt by gram, equal strings mostly meet in one part; rebalancing splits a frequent gram, which only makes its
    # marks occur in several parts.
    contexts = saved(texts.join(wanted.groupBy("doc").agg(F.collect_list(F.struct("gram", "at")).alias("rows")), "doc")
                     .mapInArrow(lean(_contexts(length)), "gram long, doc long, pos long, before long, after long, context binary")
                     .hint("rebalance", "gram").sortWithinPartitions("gram", "doc", "pos"))
    twice = lambda df, c: df.groupBy(c).count().where("count > 1").select(c)
    halves = key_filter(twice(contexts.select(F.explode(F.array("before", "after")).alias("k")).where("k is not null"), "k"), "k")
    parts = saved(contexts.mapInArrow(lean(_strings(length, halves)), f"mark long, doc long, {span}"))
    marks = key_filter(twice(parts.where("mark is not null"), "mark"), "mark")
    later = (contexts.mapInArrow(lean(_strings(length, halves, marks)), "block long, mark long, doc long, start long, bytes binary")
             .repartition(n, "block").sortWithinPartitions("block", "mark", "doc", "start")
             .mapInArrow(lean(_later(length)), f"doc long, {span}"))
    inside = parts.where("mark is null").select("doc", "start", "stop")
    cuts = saved(later.unionAll(inside).unionAll(whole)
                 .groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("cuts")))
    bitmap = key_filter(cuts.select(F.xxhash64("doc").alias("k")), "k")
    kinds = "".join(f", `{c}` {docs.select(c).schema[0].dataType.simpleString()}" for c in carry)
    clean = (hashed.mapInArrow(lean(_where(bitmap, False)), hashed.schema)
             .withColumn("cuts", F.lit(None).cast("array<struct<start: long, stop: long>>")))
    cut = hashed.mapInArrow(lean(_where(bitmap, True)), hashed.schema).join(cuts, "doc", "left")
    columns = ["id", "t", *extra, "cuts"]
    return clean.select(*columns).unionAll(cut.select(*columns)).mapInArrow(
        lean(_apply([id_col, "n_bytes", "spans", "kept", *carry])),
        f"`{id_col}` {kind}, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary{kinds}")


def digests(removed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of ``remove_repeats``' rows."""
    return removed.select(id_col, "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                          F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
