"""Substring dedup by recompression.

Words are level-0 symbols.  A first round names maximal runs of one word; each
later round splits the alphabet by a bit of every symbol's name into left and
right symbols and names each adjacent left-right pair.  A name is the hash of
what it stands for, so naming is global without a dictionary: equal substrings
get equal symbols inside, whichever document and task they are in.  Every
symbol carries the words that its making depended on; a window of `window`
words *owns* the longest symbol (ties: by name) that depends on no word outside
the window.  Equal windows own equal symbols, so only windows whose symbol
occurs elsewhere can repeat: shared symbols reveal, and the windows that own
them are then verified by 128 bits of hash of their whole word sequence (two
hashes of words and windows with seeds of their own, so that among 10^13
windows the chance of any error is about 10^-13).  A window that owns no
symbol (inside a long run, say) stands for itself in the same exchange.

Both exchanges send a block's distinct keys to key ranges and get an aligned
answer back (see ``exchange``).  Nothing is capped.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomgraph.llm import exchange
from loomgraph.llm.kernel import U, cuts, expand, grams, mix, pack, slices, squeeze, texts, tidied, unpack, words

WINDOW = 20
ROUNDS = 5
_LENGTH_BITS = U(58)


def symbols(hashes: np.ndarray, first: np.ndarray, rounds: int, window: int):
    """Names, lengths and dependencies [left, right) of the last round's symbols.

    `first` marks the first word of each document; no symbol crosses it.
    """
    n = len(hashes)
    new = first.copy()
    new[1:] |= hashes[1:] != hashes[:-1]
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, n))
    name = np.where(length == 1, hashes[start], mix(hashes[start] + length.astype(U) * U(0x9E3779B97F4A7C15)))
    left, right, head = start - 1, start + length + 1, first[start]
    for level in range(rounds):
        m = len(name)
        if m < 2:
            break
        is_left = (mix(name + U(level + 1)) & U(1)) == 0
        pair = np.zeros(m, bool)
        pair[:-1] = is_left[:-1] & ~is_left[1:] & ~head[1:] & (length[:-1] + length[1:] <= window)
        second = np.zeros(m, bool)
        second[1:] = pair[:-1]
        # a symbol that stays depends on the neighbour that it might have joined
        other = np.where(is_left, np.minimum(np.arange(m) + 1, m - 1), np.maximum(np.arange(m) - 1, 0))
        reach_l, reach_r = np.minimum(left, left[other]), np.maximum(right, right[other])
        edge = np.where(is_left, np.append(head[1:], True), head)
        reach_l = np.where(edge & ~is_left, np.minimum(left, left - 1), reach_l)
        reach_r = np.where(edge & is_left, right + 1, reach_r)
        reach_l, reach_r = np.where(edge & is_left, left, reach_l), np.where(edge & ~is_left, right, reach_r)
        nxt = np.minimum(np.arange(m) + 1, m - 1)
        joined = mix(name * U(0xD6E8FEB86659FD93) + mix(name[nxt] + U(7)))
        keep = ~second
        name = np.where(pair, joined, name)[keep]
        left_new = np.where(pair, np.minimum(left, left[nxt]), reach_l)[keep]
        right = np.where(pair, np.maximum(right, right[nxt]), reach_r)[keep]
        length = np.where(pair, length + length[nxt], length)[keep]
        left, head = left_new, head[keep]
    return name, length, left, right


def owners(hashes: np.ndarray, bounds: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS, places: bool = True):
    """Starts of all windows, the name that each owns and (if asked) where that first stands, of rows whose words begin at `bounds`."""
    n = len(hashes)
    inside = np.zeros(n + 1, np.int32)
    sizes = np.diff(bounds)
    fit = sizes >= window
    np.add.at(inside, bounds[:-1][fit], 1)
    np.add.at(inside, bounds[1:][fit] - window + 1, -1)
    at = np.flatnonzero(np.cumsum(inside)[:n] > 0)
    if not len(at):
        return at, np.zeros(0, U), at
    first = np.zeros(n, bool)
    first[bounds[:-1][sizes > 0]] = True
    name, length, left, right = symbols(hashes, first, rounds, window)
    rank = (np.minimum(length, 63).astype(U) << _LENGTH_BITS) | (name >> U(6))
    best = np.zeros(n, U)
    slack = window - (right - left)
    for step in range(window):
        take = (slack >= step) & (left - step >= 0)
        if not take.any():
            break
        np.maximum.at(best, left[take] - step, rank[take])
    place = np.full(n, n, np.int64)
    for step in range(window if places else 0):
        take = np.flatnonzero((slack >= step) & (left - step >= 0))
        take = take[best[left[take] - step] == rank[take]]
        np.minimum.at(place, left[take] - step, left[take])
    best, place = best[at], place[at]
    alone = best == 0
    if alone.any():
        whole = grams(hashes, window)
        best[alone] = whole[at[alone]] >> U(6)
        place[alone] = -1 - at[alone]
    return at, mix(best), place


def _block(table: pa.Table):
    """The block's rows in the order of (doc_id, text), in pieces: ids, raw bytes, offsets, words, bounds."""
    ids = table["doc_id"].combine_chunks()
    known = np.asarray(ids.is_valid())
    ids = np.asarray(ids.fill_null(np.iinfo(np.int64).min))
    data, offsets = texts(table["text"])
    tie = np.array([int.from_bytes(hashlib.blake2b(data[a:b].tobytes(), digest_size=4).digest(), "big") for a, b in zip(offsets[:-1], offsets[1:])], np.uint32)
    order = np.lexsort((tie, ids))
    return ids[order], known[order], tie[order], data, offsets, order


def _pieces(data, offsets, order):
    """Consecutive runs of rows in that order, as (rows, hashes, bounds)."""
    sizes = np.append(0, np.cumsum(np.diff(offsets)[order]))
    for a, b in slices(sizes):
        hashes, bounds = words(*_text(data, offsets, order[a:b]), False)
        yield a, b, hashes, bounds


def _text(data, offsets, rows):
    """The bytes and offsets of some rows."""
    part = np.concatenate([data[offsets[r] : offsets[r + 1]] for r in rows]) if len(rows) else data[:0]
    return part, np.append(0, np.cumsum((offsets[1:] - offsets[:-1])[rows]))


def _messages(block: int, keys: np.ndarray, lay: exchange.Layout, bits: int, more=()):
    """One row a bucket that the sorted keys reach; `more` are columns aligned with the keys."""
    at = cuts(keys, lay.buckets, bits)
    out = {"bucket": [], "block": [], "keys": [], **{f"c{k}": [] for k in range(len(more))}}
    for b in range(lay.buckets):
        lo, hi = at[b], at[b + 1]
        if lo < hi:
            out["bucket"].append(b)
            out["block"].append(block)
            out["keys"].append(pack(keys[lo:hi]))
            for k, column in enumerate(more):
                out[f"c{k}"].append(squeeze(column[lo:hi]))
    return out


def _names(table: pa.Table, lay: exchange.Layout, window: int, rounds: int):
    """All names that the block's windows own: sorted distinct keys, and whether a key is owned in two places."""
    ids, known, tie, data, offsets, order = _block(table)
    found = []
    for a, b, hashes, bounds in _pieces(data, offsets, order):
        at, name, place = owners(hashes, bounds, window, rounds)
        new = np.ones(len(at), bool)
        new[1:] = (name[1:] != name[:-1]) | (place[1:] != place[:-1])
        found.append(name[new])
    found = np.concatenate(found) if found else np.zeros(0, U)
    return np.unique(found >> U(64 - lay.bits), return_counts=True)


@tidied
def _send_names(table: pa.Table, lay, window, rounds) -> pa.Table:
    keys, count = _names(table, lay, window, rounds)
    return pa.table(_messages(table["block"][0].as_py(), keys, lay, lay.bits, [np.minimum(count, 2).astype(np.uint8)]), schema=_SENT)


_SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("c0", pa.binary())])
_SENT_SQL = "bucket int, block int, keys binary, c0 binary"
_REPLY = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("flags", pa.binary())])
_REPLY_SQL = "block int, bucket int, flags binary"


def _answer(blocks, bucket, parts, flags) -> pa.Table:
    ends = np.append(0, np.cumsum([len(p) for p in parts]))
    return pa.table({"block": blocks, "bucket": [bucket] * len(blocks), "flags": [squeeze(np.packbits(flags[a:b])) for a, b in zip(ends[:-1], ends[1:])]}, schema=_REPLY)


@tidied
def _share_names(table: pa.Table) -> pa.Table:
    parts = [unpack(x) for x in table["keys"].to_pylist()]
    counts = np.concatenate([expand(x, np.uint8) for x in table["c0"].to_pylist()])
    _, back = np.unique(np.concatenate(parts), return_inverse=True)
    return _answer(table["block"].to_pylist(), table["bucket"][0].as_py(), parts, (np.bincount(back, counts) >= 2)[back])


def _flags(replies: pa.Table, count: int, at: np.ndarray) -> np.ndarray:
    """The answers to `count` sorted keys cut at `at`, in the keys' order."""
    out = np.zeros(count, bool)
    for bucket, blob in zip(replies["bucket"].to_pylist(), replies["flags"].to_pylist()):
        lo, hi = at[bucket], at[bucket + 1]
        out[lo:hi] = np.unpackbits(expand(blob, np.uint8))[: hi - lo]
    return out


def _windows(table: pa.Table, replies: pa.Table, lay, window, rounds):
    """Windows that own a shared name: their keys, second keys, row in order, and start; in order of place."""
    ids, known, tie, data, offsets, order = _block(table)
    pieces, names = [], []
    for a, b, hashes, bounds in _pieces(data, offsets, order):
        at, name, _ = owners(hashes, bounds, window, rounds, places=False)
        name >>= U(64 - lay.bits)
        pieces.append((a, b, bounds, at, name, grams(hashes, window)[at] if len(at) else np.zeros(0, U)))
        names.append(np.unique(name))
    names = np.unique(np.concatenate(names)) if names else np.zeros(0, U)
    shared = names[_flags(replies, len(names), cuts(names, lay.buckets, lay.bits))]
    keys, seconds, rows, starts = [], [], [], []
    for a, b, bounds, at, name, key in pieces if len(shared) else ():
        hit = shared[np.minimum(np.searchsorted(shared, name), len(shared) - 1)] == name
        at = at[hit]
        if not len(at):
            continue
        seconds.append(grams(words(*_text(data, offsets, order[a:b]), False, 1)[0], window)[at])
        row = np.searchsorted(bounds, at, "right") - 1
        keys.append(key[hit])
        rows.append(row + a)
        starts.append(at - bounds[row])
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return ids, known, tie, data, offsets, order, join(keys, U), join(seconds, U), join(rows, np.int64), join(starts, np.int64)


def _distinct(keys: np.ndarray, seconds: np.ndarray):
    """Where each distinct pair of keys, in their order, stands first."""
    order = np.lexsort((seconds, keys))
    new = np.ones(len(keys), bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]) | (seconds[order][1:] != seconds[order][:-1])
    return order[new]


_PLACES_SQL = "bucket int, block int, keys binary, c0 binary, c1 binary, c2 binary, c3 binary"
_PLACES = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("c0", pa.binary()), ("c1", pa.binary()), ("c2", pa.binary()), ("c3", pa.binary())])


@tidied
def _send_places(table: pa.Table, replies: pa.Table, lay, window, rounds) -> pa.Table:
    if not table.num_rows:
        return _PLACES.empty_table()
    ids, known, tie, *_, keys, seconds, rows, starts = _windows(table, replies, lay, window, rounds)
    first = _distinct(keys, seconds)
    rows, starts = rows[first], starts[first]
    return pa.table(_messages(table["block"][0].as_py(), keys[first], lay, 64, [ids[rows], tie[rows], starts.astype(np.uint32), seconds[first]]), schema=_PLACES)


@tidied
def _first_places(table: pa.Table) -> pa.Table:
    parts = [unpack(x) for x in table["keys"].to_pylist()]
    keys = np.concatenate(parts)
    ids, ties, starts, seconds = (np.concatenate([expand(x, kind) for x in table[c].to_pylist()]) for c, kind in (("c0", np.int64), ("c1", np.uint32), ("c2", np.uint32), ("c3", U)))
    order = np.lexsort((starts, ties, ids, seconds, keys))
    lead = np.ones(len(keys), bool)
    lead[1:] = (keys[order][1:] != keys[order][:-1]) | (seconds[order][1:] != seconds[order][:-1])
    flags = np.zeros(len(keys), bool)
    flags[order[lead]] = True
    return _answer(table["block"].to_pylist(), table["bucket"][0].as_py(), parts, flags)


_KEPT_SQL = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


@tidied
def _cut(table: pa.Table, replies: pa.Table, lay, window, rounds, with_text) -> pa.Table:
    if not table.num_rows:
        return _KEPT.empty_table()
    shares, places = (replies.filter(pa.compute.equal(replies["phase"], k)) for k in (1, 2))
    ids, known, tie, data, offsets, order, keys, seconds, rows, starts = _windows(table, shares, lay, window, rounds)
    first = _distinct(keys, seconds)
    stays = _flags(places, len(first), cuts(keys[first], lay.buckets, 64))
    earliest = np.zeros(len(keys), bool)
    earliest[first] = stays
    rows, starts = rows[~earliest], starts[~earliest]
    at = np.searchsorted(rows, np.arange(len(order) + 1))
    out = {k: [] for k in _KEPT.names}
    for k, r in enumerate(order):
        own = data[offsets[r] : offsets[r + 1]].tobytes().split()
        kept = own
        if at[k] < at[k + 1]:
            cover = np.zeros(len(own) + 1, np.int32)
            s = starts[at[k] : at[k + 1]]
            np.add.at(cover, s, 1)
            np.add.at(cover, s + window, -1)
            kept = list(compress(own, np.cumsum(cover[:-1]) == 0))
        joined = b" ".join(kept)
        for c, v in zip(out, (int(ids[k]) if known[k] else None, len(own), len(own) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode() if with_text else None)):
            out[c].append(v)
    return pa.table(out, schema=_KEPT)


def remove_repeats(docs: DataFrame, *, id: str = "doc_id", text: str = "text", window: int = WINDOW, rounds: int = ROUNDS, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept: each row's words without those in a repeated window.

    A window of `window` consecutive words goes if its words also start
    earlier: in a smaller id, or earlier in the same row.  Rows of equal id are
    ordered by a hash of their text, equal rows arbitrarily; a null id counts as
    the smallest.  Null text is empty.  Other columns are not read.  `kept` is
    null unless with_text.
    Ids are whole numbers.  A text is worked on whole by one task, in some twenty
    times its size; so are rows equal in id and text, which share a block.
    """
    from pyspark.sql import functions as F

    lay = exchange.layout(docs, text)
    blocks = exchange.blocked(docs, lay.blocks, id, text)
    sent = blocks.groupBy("block").applyInArrow(lambda t: _send_names(t, lay, window, rounds), _SENT_SQL)
    shared = sent.groupBy("bucket").applyInArrow(_share_names, _REPLY_SQL)
    places = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(lambda a, b: _send_places(a, b, lay, window, rounds), _PLACES_SQL)
    earliest = places.groupBy("bucket").applyInArrow(_first_places, _REPLY_SQL)
    replies = shared.withColumn("phase", F.lit(1)).unionByName(earliest.withColumn("phase", F.lit(2)))
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(lambda a, b: _cut(a, b, lay, window, rounds, with_text), _KEPT_SQL)


def op6_substring_dedup(spark, sf_dir):
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=False).drop("kept")


OP6_SQL = r"""
with w as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as ws from documents),
win as (select doc_id, k, array_to_string(ws[k:k + 19], ' ') as run from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as k from w where len(ws) >= 20)),
late as (select doc_id, k from (select doc_id, k, row_number() over (partition by run order by doc_id, k) as r from win) where r > 1),
gone as (select distinct doc_id, k + j as i from late, (select unnest(range(0, 20)) as j)),
one as (select doc_id, i, ws[i] as word from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from w)),
kept as (select o.doc_id, count(*) as n, string_agg(o.word, ' ' order by o.i) as said from one o left join gone g on g.doc_id = o.doc_id and g.i = o.i where g.i is null group by o.doc_id)
select w.doc_id, len(w.ws)::bigint as n_words, (len(w.ws) - coalesce(k.n, 0))::bigint as n_removed, sha256(coalesce(k.said, '')) as kept_sha256
from w left join kept k on k.doc_id = w.doc_id
"""
