"""N-gram Jaccard join by grouped prefixes.

Texts with equal shingle sets are one *class*.  Shingles are ordered by how
many classes hold them, rarest first.  Two sets of Jaccard similarity t or more
share a shingle among the first n - ceil(t n) + 1 of each: their prefixes.
Shingles that no other class holds cannot be shared and are left out of the
prefix, so most texts have an empty one and are done.

Classes with equal prefix and size form a *group*, which its most central class
leads (the one whose shingles are the most frequent).  Everything that the
prefix filter asks is asked of groups: a group stands for its classes in the
postings, and the size and position bounds filter pairs of groups.

1. *Stars.*  Each class is verified against its leader, and each leader against
   the hub that it meets under most of its shingles.  This joins most near
   copies into components at a cost linear in the classes.
2. *Group pairs.*  Groups that meet under a prefix shingle and are not known to
   be in one component are filtered by the bounds, expanded to their classes,
   and the pairs of classes of different components verified on whole sets.
   No link between components is lost.
3. *Links inside components*, if their number is asked for: a component's
   classes are cut into pieces of a bounded size, and every two pieces are
   counted by a product of their membership matrices; only sums leave a task.
   This is quadratic in a component's different texts, which any exact count of
   its links is; copies of one text are one class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.graph.components import connected_components
from loomgraph.llm import exchange
from loomgraph.llm.kernel import U, cuts, expand, grams, mix, pack, remembered, slices, squeeze, texts, tidied, tidy, unpack, words
from loomgraph.storage import settle

WORDS = 5
#: The similarity, in hundredths.
PERCENT = 75


def _sets(table: pa.Table, n: int):
    """Distinct shingle sets of the block: sorted members end to end, where each begins, class ids, and each row's set."""
    data, offsets = texts(table["text"])
    sets, ids, row_set, known = [], [], np.zeros(table.num_rows, np.int64), {}
    at = 0
    for a, b in slices(offsets):
        hashes, bounds = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], True)
        runs = grams(hashes, n)
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi - lo >= n:
                members = np.unique(runs[lo : hi - n + 1])
            else:
                members = mix(grams(hashes[lo:hi], hi - lo) + U(hi - lo)) if hi > lo else hashes[:0]
            name = (int(np.bitwise_xor.reduce(mix(members + U(1)))) + 3 * int(mix(members).sum(dtype=U)) + len(members)) % (1 << 64)
            k = known.setdefault(name, len(sets))
            if k == len(sets):
                sets.append(members)
                ids.append(name)
            row_set[at] = k
            at += 1
    bounds = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, U), bounds, mix(np.array(ids, U)), row_set


_SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("count", pa.binary())])
_SENT_SQL = "bucket int, block int, keys binary, count binary"
_REPLY = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("level", pa.binary())])
_REPLY_SQL = "block int, bucket int, level binary"
_CLASS = pa.schema([("class", pa.int64()), ("n", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64())), ("places", pa.list_(pa.int32())), ("centre", pa.float32()), ("members", pa.binary())])
_CLASS_SQL = "class long, n int, doc_ids array<long>, tokens array<long>, places array<int>, centre float, members binary"


@tidied
def _send(table: pa.Table, lay: exchange.Layout, n: int) -> pa.Table:
    members, *_ = _sets(table, n)
    keys, count = np.unique(members >> U(64 - lay.bits), return_counts=True)
    at = cuts(keys, lay.buckets, lay.bits)
    full = [b for b in range(lay.buckets) if at[b] < at[b + 1]]
    return pa.table({"bucket": full, "block": [table["block"][0].as_py()] * len(full), "keys": [pack(keys[at[b] : at[b + 1]]) for b in full], "count": [squeeze(count[at[b] : at[b + 1]].astype(np.uint32)) for b in full]}, schema=_SENT)


@tidied
def _frequencies(table: pa.Table) -> pa.Table:
    """Level 0 for a shingle of one class, else a byte that grows with the logarithm of their number."""
    parts = [unpack(x) for x in table["keys"].to_pylist()]
    counts = np.concatenate([expand(x, np.uint32) for x in table["count"].to_pylist()])
    _, back = np.unique(np.concatenate(parts), return_inverse=True)
    level = np.minimum(np.round(np.log2(np.bincount(back, counts)) * 7), 255).astype(np.uint8)[back]
    ends = np.append(0, np.cumsum([len(p) for p in parts]))
    return pa.table({"block": table["block"], "bucket": table["bucket"], "level": [squeeze(level[a:b]) for a, b in zip(ends, ends[1:])]}, schema=_REPLY)


@tidied
def _classes(table: pa.Table, replies: pa.Table, lay: exchange.Layout, n: int, percent: int) -> pa.Table:
    if not table.num_rows:
        return _CLASS.empty_table()
    members, bounds, ids, row_set = _sets(table, n)
    short = members >> U(64 - lay.bits)
    keys, back = np.unique(short, return_inverse=True)
    at, level = cuts(keys, lay.buckets, lay.bits), np.zeros(len(keys), np.uint8)
    for bucket, blob in zip(replies["bucket"].to_pylist(), replies["level"].to_pylist()):
        level[at[bucket] : at[bucket + 1]] = expand(blob, np.uint8)
    level = level[back]
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(level, kind="stable")
    order = order[np.argsort(owner[order].astype(np.uint16 if len(sizes) < 1 << 16 else np.int64), kind="stable")]
    place = np.arange(len(order)) - bounds[owner]
    first = place < (sizes - -(-percent * sizes // 100) + 1)[owner]
    used = first & (level[order] > 0)
    cut = np.append(0, np.cumsum(np.bincount(owner[used], minlength=len(sizes))))
    tokens = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(members[order][used].view(np.int64)))
    places = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(place[used].astype(np.int32)))
    centre = np.bincount(owner, level, minlength=len(sizes)) / np.maximum(sizes, 1)
    rows = np.argsort(row_set, kind="stable")
    docs = table["doc_id"].combine_chunks().take(pa.array(rows))
    docs = pa.ListArray.from_arrays(pa.array(np.searchsorted(row_set[rows], np.arange(len(sizes) + 1)), pa.int32()), docs)
    # whole sets are kept for verifying, of the classes that can be in a pair
    blobs = [members[a:b].tobytes() if x < y else None for a, b, x, y in zip(bounds, bounds[1:], cut, cut[1:])]
    return pa.table({"class": ids.view(np.int64), "n": sizes.astype(np.int32), "doc_ids": docs, "tokens": tokens, "places": places, "centre": centre.astype(np.float32), "members": pa.array(blobs, pa.binary())}, schema=_CLASS)


def _verified(percent: int):
    """Keeps rows (a, b, set_a, set_b) whose sets are similar enough."""

    def run(batches):
        remembered()
        for batch in batches:
            a, b = [], []
            last, right = None, None
            for x, y, p, q in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "set_a", "set_b"))):
                if y != last:
                    last, right = y, np.frombuffer(q, U)
                left = np.frombuffer(p, U)
                at = np.searchsorted(right, left)
                at[at == len(right)] = 0
                shared = int((right[at] == left).sum())
                if 100 * shared >= percent * (len(left) + len(right) - shared):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
        tidy()

    return run


def verify(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of classes whose sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("class").alias("a"), F.col("members").alias("set_a"))
    right = sets.select(F.col("class").alias("b"), F.col("members").alias("set_b"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(_verified(percent), "a long, b long")


def _may(n, place, other_n, other_place, percent):
    """Whether sets of n and other_n members that meet first at these places can be similar enough."""
    need = F.ceil((n + other_n) * F.lit(percent) / F.lit(100 + percent) - 1e-9)
    return F.least(n - place, other_n - other_place) >= need


#: Bytes of members in a piece of a component, and columns multiplied at once, where links are counted.
PIECE_BYTES, COLUMNS = 1 << 23, 4096
#: Rows of a hot class or component are dealt to so many tasks.
SALTS = 16
_COUNTED = pa.schema([("class", pa.int64()), ("links", pa.int64())])


@tidied
def _count_links(table: pa.Table, percent: int) -> pa.Table:
    """For each class of two pieces of a component, the documents that it links with in the other one (or in its own, if they are one)."""
    piece, docs = np.asarray(table["piece"]), np.asarray(table["docs"])
    sets = [np.frombuffer(x.as_buffer(), U) for x in table["members"]]
    sizes = np.array([len(x) for x in sets])
    members = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(members, return_inverse=True, return_counts=True)
    met = count[column] > 1  # what one class alone holds is not shared
    owner, column = owner[met], column[met]
    kept, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
    left, right, one = np.flatnonzero(piece == lo), np.flatnonzero(piece == hi), lo == hi
    if not len(left) or not len(right):
        return _COUNTED.empty_table()
    shared = np.zeros((len(left), len(right)), np.float64)
    for at in range(0, len(kept), COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        held = np.zeros((len(sets), min(COLUMNS, len(kept) - at)), np.float32)
        held[owner[a:b], column[a:b] - at] = 1
        shared += held[left] @ held[right].T
    shared = np.rint(shared).astype(np.int64)
    linked = 100 * shared >= percent * (sizes[left][:, None] + sizes[right][None, :] - shared)
    if one:
        np.fill_diagonal(linked, False)
    ids, links = [np.asarray(table["class"])[left]], [linked @ docs[right]]
    if not one:
        ids.append(np.asarray(table["class"])[right])
        links.append(linked.T @ docs[left])
    return pa.table({"class": np.concatenate(ids), "links": np.concatenate(links)}, schema=_COUNTED)


def count_links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(class, links) of sets (class, component, docs, members): the documents of other classes of the component that a class links with."""
    size = sets.groupBy("component").agg(F.ceil(F.sum(F.length("members")) / PIECE_BYTES).cast("int").alias("pieces"), F.count("*").alias("many")).where("many > 1").select("component", "pieces")
    salted = sets.withColumn("salt", F.pmod(F.xxhash64("class"), F.lit(SALTS)).cast("int"))
    dealt = salted.join(_salted(size), ["component", "salt"]).withColumn("piece", F.pmod(F.xxhash64("class"), F.col("pieces")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    dealt = dealt.select("component", "class", "docs", "members", "piece", other.alias("other"))
    # one struct, so that the pairs of a component are dealt to all tasks
    pair = F.struct("component", F.least("piece", "other").alias("lo"), F.greatest("piece", "other").alias("hi")).alias("pair")
    dealt = dealt.select(pair, F.least("piece", "other").alias("lo"), F.greatest("piece", "other").alias("hi"), "class", "docs", "members", "piece")
    counted = dealt.groupBy("pair").applyInArrow(lambda t: _count_links(t, percent), "class long, links long")
    return counted.groupBy("class").agg(F.sum("links").alias("links"))


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def near_components(docs: DataFrame, *, id: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT, links: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id of every row of docs, and n_links if `links`.

    A text's set holds its distinct shingles of n words (runs of bytes but
    blanks, A-Z lower-cased); a shorter text is one shingle.  Rows link if
    100 * intersection >= percent * union; component_id is the least doc_id
    that links reach.  class_id is the least doc_id of the rows with an equal
    set; n_links counts the other rows that a row links with, those of its class
    included.  Null and blank texts have empty sets and are their own
    component, without links.  A null id takes part, but is no component_id
    unless its component has no other id.  Repeated rows link like any equal
    texts.
    Ids are whole numbers.  A text is worked on whole by one task, in some eight
    times its size; so are rows equal in id and text, which share a block.
    """
    lay = exchange.layout(docs, text)
    blocks = exchange.blocked(docs, lay.blocks, id, text)
    replies = blocks.groupBy("block").applyInArrow(lambda t: _send(t, lay, n), _SENT_SQL).groupBy("bucket").applyInArrow(_frequencies, _REPLY_SQL)
    local = settle(blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(lambda a, b: _classes(a, b, lay, n, percent), _CLASS_SQL))

    # one row a class, of those that can be in a pair, and one a group
    full = local.where(F.size("tokens") > 0)
    one = F.struct("n", F.xxhash64("n", "tokens").alias("group"), "tokens", "places", "centre", "members")
    classes = settle(full.groupBy("class").agg(F.first(one).alias("x")).select("class", "x.*"))
    groups = classes.groupBy("group").agg(F.max(F.struct("centre", "class")).alias("h"), F.first(F.struct("n", F.arrays_zip("tokens", "places").alias("prefix"))).alias("g"))
    groups = settle(groups.select("group", F.col("h.class").alias("head"), F.col("h.centre").alias("centre"), "g.n", "g.prefix"))
    posted = groups.select("group", "head", "centre", "n", F.explode("prefix").alias("t")).select("group", "head", "centre", "n", F.col("t.tokens").alias("token"), F.col("t.places").alias("place"))

    # 1. stars
    in_group = classes.select("class", "group").join(groups.select("group", "head"), "group").where(F.col("class") != F.col("head")).select(F.col("class").alias("a"), F.col("head").alias("b"))
    hubs = posted.groupBy("token").agg(F.max(F.struct("centre", "head", "n", "place")).alias("hub"), F.count("*").alias("met")).where(F.col("met") > 1).select("token", "hub")
    with_hub = posted.join(hubs, "token").where((F.col("head") != F.col("hub.head")) & _may(F.col("n"), F.col("place"), F.col("hub.n"), F.col("hub.place"), percent))
    voted = with_hub.groupBy("head", F.col("hub.head").alias("b")).agg(F.count("*").alias("votes"), F.max("hub.centre").alias("centre"))
    best = voted.groupBy("head").agg(F.max_by("b", F.struct("votes", "centre", "b")).alias("b")).select(F.col("head").alias("a"), "b")
    sets = classes.select("class", "members")
    stars = settle(verify(best.unionByName(in_group), sets, percent))
    known = connected_components(stars, "a", "b").select(F.col("node").alias("class"), "component")

    # 2. pairs of groups; a group whose classes are in several components is its own kind, and meets itself too
    member = settle(classes.select("class", "group").join(known, "class", "left").withColumn("component", F.coalesce("component", "class")))
    kind = member.groupBy("group").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).select("group", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("kind"), (F.col("lo") < F.col("hi")).alias("mixed"))
    named = settle(posted.select("group", "n", "token", "place").join(kind, "group").withColumn("kind", F.coalesce("kind", F.xxhash64("group", F.lit("mixed")))))
    counts = named.groupBy("token", "kind").agg(F.count("*").alias("c"))
    main = counts.groupBy("token").agg(F.max_by("kind", F.struct("c", "kind")).alias("main"), F.count("*").alias("kinds")).where(F.col("kinds") > 1).select("token", "main")
    split = named.join(main, "token")
    minor = split.where(F.col("kind") != F.col("main")).select("token", F.col("group").alias("a"), F.col("n").alias("n_a"), F.col("place").alias("place_a"), F.col("kind").alias("kind_a"))
    other = split.select("token", F.col("group").alias("b"), F.col("n").alias("n_b"), F.col("place").alias("place_b"), F.col("kind").alias("kind_b"), (F.col("kind") == F.col("main")).alias("is_main"))
    met = minor.join(other, "token").where((F.col("kind_a") != F.col("kind_b")) & (F.col("is_main") | (F.col("a") < F.col("b"))) & _may(F.col("n_a"), F.col("place_a"), F.col("n_b"), F.col("place_b"), percent))
    itself = kind.where("mixed").select(F.col("group").alias("a"), F.col("group").alias("b"))
    group_pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().unionByName(itself)
    left = member.select(F.col("group").alias("a"), F.col("class").alias("class_a"), F.col("component").alias("component_a"))
    right = member.select(F.col("group").alias("b"), F.col("class").alias("class_b"), F.col("component").alias("component_b"))
    expanded = group_pairs.join(left, "a").join(right, "b").where((F.col("component_a") != F.col("component_b")) & ((F.col("a") != F.col("b")) | (F.col("class_a") < F.col("class_b"))))
    verified = settle(verify(expanded.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")), sets, percent))
    whole = connected_components(stars.unionByName(verified), "a", "b").select(F.col("node").alias("class"), "component")

    # every class's least id and number of rows; components and classes may hold most rows, so joins by them are salted
    facts = local.groupBy("class").agg(F.min(F.array_min("doc_ids")).alias("own"), F.sum(F.size("doc_ids")).alias("docs"))
    linked = settle(whole.join(facts, "class"))
    least = linked.groupBy("component").agg(F.min("own").alias("least"))
    least = linked.withColumn("salt", F.pmod(F.xxhash64("class"), F.lit(SALTS)).cast("int")).join(_salted(least), ["component", "salt"]).select("class", "least")
    facts = facts.join(least, "class", "left").withColumn("least", F.coalesce("least", "own"))
    if links:
        counted = count_links(linked.select("class", "component", "docs").join(sets, "class"), percent)
        facts = facts.join(counted, "class", "left").withColumn("n_links", F.col("docs") - 1 + F.coalesce("links", F.lit(0)))
    else:
        facts = facts.withColumn("n_links", F.lit(0))
    found = local.select("class", "n", "doc_ids", F.pmod(F.xxhash64("doc_ids"), F.lit(SALTS)).cast("int").alias("salt")).join(_salted(facts.select("class", "least", "own", "n_links")), ["class", "salt"])
    out = found.select(F.explode("doc_ids").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), "least", F.col("own").alias("class_id"), "n_links")
    blank = F.col("n_shingles") == 0
    out = out.select("doc_id", "n_shingles", F.when(blank, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"), F.when(blank, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.when(blank, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"))
    return out if links else out.drop("n_links")


def keep_one(docs: DataFrame, *, id: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each component: the one of least id, null last, then of least key; blank texts all stay.

    Rows are told apart by id and text, so null ids and an id of several texts
    are decided text by text; rows equal in both stay together.
    """
    key = exchange.row_key(id, text)
    found = settle(near_components(docs.select(key.alias("doc_id"), F.col(f"`{text}`").alias("text")), n=n, percent=percent).where("n_shingles > 0").select(F.col("doc_id").alias("_key"), "component_id").distinct())
    ids = docs.select(key.alias("_key"), F.col(f"`{id}`").cast("long").alias("_id")).distinct()
    first = found.join(ids, "_key").groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_key")).alias("x"))
    gone = found.select("_key").join(first.select(F.col("x._key").alias("_key")), "_key", "left_anti").select(F.col("_key").alias("_gone"))
    rows = docs.select(F.struct("*").alias("_row"), key.alias("_key"))
    return rows.join(gone, F.col("_key") == F.col("_gone"), "left_anti").select("_row.*")


def op1_ngram_jaccard(spark, sf_dir):
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), links=True)


OP1_SQL = r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as ws from documents),
s as (select distinct doc_id, array_to_string(ws[k:k + 4], ' ') as g from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as k from w where len(ws) > 0)),
keyed as (select doc_id, count(*) as n, md5(string_agg(g, chr(10) order by g)) as k from s group by doc_id),
class as (select k, min(doc_id) as id, count(*) as docs, min(n) as n from keyed group by k),
held as (select c.id, c.n, c.docs, s.g from class c join s on s.doc_id = c.id),
met as (select a.id as a, b.id as b, a.n as na, b.n as nb, b.docs, count(*) as c from held a join held b on a.g = b.g and a.id <> b.id group by a.id, b.id, a.n, b.n, b.docs),
link as (select a, b, docs from met where 100 * c >= 75 * (na + nb - c)),
reach(a, b) as (select id, id from class union select r.a, l.b from reach r join link l on l.a = r.b),
least as (select a, min(b) as least from reach group by a),
more as (select a, sum(docs)::bigint as docs from link group by a)
select d.doc_id, coalesce(k.n, 0)::bigint as n_shingles, coalesce(l.least, d.doc_id) as component_id, coalesce(c.id, d.doc_id) as class_id, coalesce(c.docs - 1 + coalesce(m.docs, 0), 0)::bigint as n_links
from documents d left join keyed k on k.doc_id = d.doc_id left join class c on c.k = k.k left join least l on l.a = c.id left join more m on m.a = c.id
"""
