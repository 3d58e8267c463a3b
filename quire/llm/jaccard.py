"""Exact set-similarity join of documents on word shingles.

Prefix filtering with an inverted index: shingles are ordered rare first, and
two sets that are similar enough share one among the first quarter of each.
Index lists are ordered by set size and skipped by it, and entries whose
position leaves too little room for the needed overlap are skipped too
(index-level skipping). Inside long lists a set is first compared with the
list's leader; sets that turn out to be linked inherit each other's answers, and
only sets still in different components are compared further, where parity
bitmaps leave room for a link (answer-level skipping).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Windows, drop_caches, hashed_words, mixed, release_memory, slices, table, written
from .graph import connected_components

WORDS = 5
#: Similarity of at least NUM / DEN.
NUM, DEN = 75, 100
#: Counters of the shingle frequency sketch (a power of two) and per block.
SKETCH, BLOCK = 1 << 21, 1 << 13


def needed(n):
    """Least overlap of a set of n shingles with any linked set."""
    return -(-NUM * n // DEN)


def prefix(n):
    return n - needed(n) + 1


def pair_overlap(n, m):
    """Least overlap of linked sets of n and m shingles."""
    return -(-NUM * (n + m) // (NUM + DEN))


def shingle_sets(texts: list[bytes | None], width: int = WORDS) -> list[np.ndarray]:
    """Each text's set of shingle hashes, sorted. A text of fewer words has its
    whole sequence as one shingle, one without words the empty set."""
    hashes, lens = hashed_words([t.lower() if t else t for t in texts])
    windows = Windows(hashes)
    grams = windows.of(width)
    ends = np.cumsum(lens)
    out = []
    for e, n in zip(ends.tolist(), lens.tolist(), strict=True):
        if n >= width:
            h = np.sort(grams[e - n:e - width + 1])
            out.append(h[np.concatenate([[True], h[1:] != h[:-1]])])
        elif n:
            h = Windows(hashes[e - n:e]).of(n) + np.uint64(n)
            out.append(mixed(h))
        else:
            out.append(hashes[:0])
    return out


def set_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit key per set, equal for equal sets."""
    bounds = np.cumsum([0, *map(len, sets)])
    all_ = mixed(np.concatenate([*sets, np.zeros(1, np.uint64)]) + np.uint64(0x632BE59BD9B4E019))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(all_, dtype=np.uint64)])
    return mixed(sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)


# --- first pass: sizes, keys, and how often shingles occur -----------------

FIRST = "doc_id {id}, h long, n long, key long, block int, counts binary"


def first_pass(docs: DataFrame, width: int) -> DataFrame:
    """Rows per document (doc_id, text hash h, n, key) and per sketch block of a task
    (block, counts). Sets met before in the task are not counted again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        counts, met, kind = np.zeros(SKETCH, dtype=np.int64), set(), None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for rows, texts in slices(batch):
                sets = shingle_sets(texts, width)
                keys = set_keys(sets)
                fresh = []
                for k, s in zip(keys.tolist(), sets, strict=True):
                    if k not in met:
                        met.add(k)
                        fresh.append(s)
                if fresh:
                    counts += np.bincount((np.concatenate(fresh) & np.uint64(SKETCH - 1))
                                          .astype(np.int64), minlength=SKETCH)
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("h"),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(keys), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                    names=["doc_id", "h", "n", "key", "block", "counts"])
        if kind is not None:
            yield sketch_rows(counts, kind)
        counts = met = None
        release_memory()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.mapInArrow(run, FIRST.format(id=kind)), "shingle-sizes")


def sketch_rows(counts: np.ndarray, kind) -> pa.RecordBatch:
    """The counters by block, saturated at a byte: a byte each, or where few are
    set three bytes for each of those (its place, then its count)."""
    small = np.minimum(counts, 255).astype(np.uint8).reshape(-1, BLOCK)
    blocks = np.flatnonzero(small.any(axis=1))
    packed = []
    for b in blocks.tolist():
        at = np.flatnonzero(small[b])
        packed.append(small[b].tobytes() if 3 * len(at) >= BLOCK else
                      at.astype("<u2").tobytes() + small[b][at].tobytes())
    n = len(blocks)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, kind), *[pa.nulls(n, pa.int64()) for _ in range(3)],
         pa.array(blocks.astype(np.int32)), pa.array(packed, pa.binary())],
        names=["doc_id", "h", "n", "key", "block", "counts"])


def unpacked(raw: bytes) -> np.ndarray:
    """A block's counters from any of its forms (four bytes each: sums)."""
    if len(raw) == BLOCK:
        return np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(raw) == 4 * BLOCK:
        return np.frombuffer(raw, np.uint32)
    n = len(raw) // 3
    out = np.zeros(BLOCK, np.uint32)
    out[np.frombuffer(raw[:2 * n], "<u2")] = np.frombuffer(raw[2 * n:], np.uint8)
    return out


def frequency_levels(sketch: DataFrame) -> np.ndarray:
    """Half-logarithmic level of every counter over all documents: SKETCH bytes,
    whatever the number of documents."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, raw in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(),
                              strict=True):
                sums[b] = sums.get(b, 0) + unpacked(raw)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()),
                 pa.array([s.astype(np.uint32).tobytes() for s in sums.values()], pa.binary())],
                names=["block", "counts"])

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in add(batches):
            raw = [np.floor(2 * np.log2(1.0 + np.frombuffer(r, np.uint32))).astype(np.uint8)
                   for r in batch.column("counts").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), pa.array([r.tobytes() for r in raw], pa.binary())],
                names=["block", "counts"])

    kind = "block int, counts binary"
    partial = sketch.select("block", "counts").mapInArrow(add, kind)
    rows = partial.repartition(32, "block").mapInArrow(level, kind).collect()
    out = np.zeros((SKETCH // BLOCK, BLOCK), dtype=np.uint8)
    for r in rows:
        out[r["block"]] = np.frombuffer(r["counts"], np.uint8)
    return out.ravel()


# --- second pass: the prefix index -----------------------------------------

def postings(docs: DataFrame, levels, width: int) -> DataFrame:
    """(shingle, key, n, pos): the prefix of every set, rarest shingle first;
    equal sets of a task give one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        level, met = levels.value, set()
        for batch in batches:
            for _, texts in slices(batch):
                sets = shingle_sets(texts, width)
                out = []
                for k, s in zip(set_keys(sets).tolist(), sets, strict=True):
                    if len(s) and k not in met:
                        met.add(k)
                        p, n = prefix(len(s)), len(s)
                        rank = level[s & np.uint64(SKETCH - 1)]
                        # s is sorted, so a stable sort by level breaks ties by hash
                        first = s[np.argsort(rank, kind="stable")[:p]]
                        out.append((first, np.full(p, k), np.full(p, n, np.int32),
                                    np.arange(p, dtype=np.int32)))
                if out:
                    c = [np.concatenate(x) for x in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[0].view(np.int64)), *map(pa.array, c[1:])],
                        names=["shingle", "key", "n", "pos"])
        met = None
        release_memory()

    return docs.select("text").mapInArrow(run, "shingle long, key long, n int, pos int")


LISTS = "list long, keys binary, sizes binary"


def index_lists(posts: DataFrame) -> DataFrame:
    """Distinct lists of two or more sets that share a prefix shingle, ordered
    by size and key, as packed keys and sizes. Sets without a feasible partner
    in their list are left out."""
    n = int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = posts.repartition(n, "shingle").sortWithinPartitions("shingle", "n", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = None, set()
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False)
                    for c in ("shingle", "key", "n", "pos")]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            # The last list may go on in the next batch.
            cut = int(np.searchsorted(cols[0], cols[0][-1])) if len(cols[0]) else 0
            held = [c[cut:] for c in cols]
            yield from found_lists([c[:cut] for c in cols], done)
        if held is not None:
            yield from found_lists(held, done)

    return dealt.mapInArrow(run, LISTS)


def found_lists(cols: list[np.ndarray], done: set) -> Iterator[pa.RecordBatch]:
    shingle, key, n, pos = cols
    if len(shingle) < 2:
        return
    same = shingle[1:] == shingle[:-1]
    # Equal sets follow one another in a list: keep one.
    keep = np.concatenate([[True], ~(same & (key[1:] == key[:-1]))])
    shingle, key, n, pos = shingle[keep], key[keep], n[keep].astype(np.int64), pos[keep]
    same = np.concatenate([[False], shingle[1:] == shingle[:-1], [False]])
    member = np.flatnonzero(same[1:] | same[:-1])
    if not len(member):
        return
    shingle, key, n, pos = shingle[member], key[member], n[member], pos[member]
    first = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
    ends = np.append(first[1:], len(shingle))
    out = []
    for a, b in zip(first.tolist(), ends.tolist(), strict=True):
        k, m, p = key[a:b], n[a:b], pos[a:b]
        if b - a == 2:
            if m[1] * NUM > m[0] * DEN or min(m[0] - p[0], m[1] - p[1]) < pair_overlap(m[0], m[1]):
                continue
        else:
            # Skip by size to the range of possible partners, then by position:
            # a set stays if its room and the best room in range may suffice.
            lo = np.searchsorted(m, needed(m))
            hi = np.searchsorted(m, m * DEN // NUM, side="right")
            alone = hi - lo < 2
            alone |= (m - p) < pair_overlap(m, m[lo])
            if alone.all():
                continue
            k, m = k[~alone], m[~alone]
            if len(k) < 2:
                continue
        raw = k.tobytes()
        sign = hash(raw)
        if sign not in done:
            if len(done) > 1 << 20:
                done.clear()
            done.add(sign)
            out.append((int(mixed(set_sum(k))[0].view(np.int64)), raw, m.astype(np.int32).tobytes()))
    if out:
        c = list(zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[0], pa.int64()), pa.array(c[1], pa.binary()), pa.array(c[2], pa.binary())],
            names=["list", "keys", "sizes"])


def set_sum(keys: np.ndarray) -> np.ndarray:
    return np.sum(mixed(keys.view(np.uint64) + np.uint64(len(keys))), dtype=np.uint64, keepdims=True)


def distinct_lists(lists: DataFrame) -> DataFrame:
    return written(lists.dropDuplicates(["list"]), "index-lists")


#: Lists up to this length are compared in full in the first round.
SHORT = 6


def first_pairs(lists: DataFrame) -> DataFrame:
    """Pairs of keys: all feasible ones of short lists; in longer lists each set
    with the leader of its range of sizes (the smallest key, so that lists of
    one group agree on few leaders)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for raw, sizes in zip(batch.column("keys").to_pylist(),
                                  batch.column("sizes").to_pylist(), strict=True):
                k, n = np.frombuffer(raw, np.int64), np.frombuffer(sizes, np.int32).astype(np.int64)
                if len(k) <= SHORT:
                    i, j = np.triu_indices(len(k), 1)
                else:
                    leaders, at = [], 0
                    while at < len(k):
                        end = int(np.searchsorted(n, n[at] * DEN // NUM, side="right"))
                        leaders += [at + int(np.argmin(k[at:end]))] * (end - at)
                        at = end
                    j = np.arange(len(k))
                    i = np.array(leaders)
                ok = (i != j) & (np.maximum(n[i], n[j]) * NUM <= np.minimum(n[i], n[j]) * DEN)
                a.append(k[i[ok]])
                b.append(k[j[ok]])
            yield pair_batch(a, b)

    return lists.mapInArrow(run, "a long, b long").distinct()


def pair_batch(a: list, b: list) -> pa.RecordBatch:
    a = np.concatenate(a) if a else np.zeros(0, np.int64)
    b = np.concatenate(b) if b else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))],
                                      names=["a", "b"])


def mixed_lists(lists: DataFrame, components: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Longer lists whose sets are in more than one component, each as an array
    of (n, key, component, bits). Lists inside one component have all their
    answers already."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("keys").to_pylist()
            size = [len(r) // 8 for r in raw]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("list").to_numpy(), size)),
                 pa.array(np.frombuffer(b"".join(raw), np.int64)),
                 pa.array(np.frombuffer(b"".join(batch.column("sizes").to_pylist()), np.int32))],
                names=["list", "key", "n"])

    long_ = lists.where(F.octet_length("keys") > 8 * SHORT)
    members = long_.mapInArrow(unpack, "list long, key long, n int").join(
        components, F.col("key") == F.col("id"), "left").select(
        "list", "key", "n", F.coalesce("component", "key").alias("component"))
    several = members.groupBy("list").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    members = written(members.join(several.select("list"), "list"), "mixed-members")
    keys = members.select("key").distinct()
    bits = restricted(bitmaps.select("key", "bits"), keys)
    grouped = members.join(bits, "key").groupBy("list").agg(F.sort_array(F.collect_list(
        F.struct("n", "key", "component", "bits"))).alias("m"))
    return written(grouped.select("m"), "mixed-lists")


def parity_bitmap(s: np.ndarray) -> np.ndarray:
    """One bit per counter, its parity over the set's hashes: the bits in which
    two sets differ are at most their symmetric difference. Four bits a member,
    512 at least, a power of two; XOR-ing the halves gives the next smaller one."""
    size = max(512, 1 << (4 * len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def parity_bitmaps(texts: DataFrame, width: int) -> DataFrame:
    """(key, size, bits) of each text's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, part in slices(batch):
                sets = shingle_sets(part, width)
                maps = [parity_bitmap(x).tobytes() for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("key"), pa.array([len(x) for x in sets], pa.int32()),
                     pa.array(maps, pa.binary())], names=["key", "size", "bits"])

    return written(texts.mapInArrow(run, "key long, size int, bits binary"), "parity-bitmaps")


def with_room(pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The pairs whose bitmaps leave room for a link."""
    a, b = (bitmaps.select(F.col("key").alias(k), F.col("size").alias(f"n{k}"),
                           F.col("bits").alias(f"bits_{k}")) for k in ("a", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in
                                    ("na", "nb", "bits_a", "bits_b")), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                words = min(len(x), len(y))
                differ = int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())
                keep.append(differ <= n + m - 2 * pair_overlap(n, m))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return written(pairs.join(a, "a").join(b, "b").mapInArrow(run, "a long, b long"), "pairs-with-room")


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    while len(bits) > words:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits


def feasible_across(n: np.ndarray, c: np.ndarray, bits: list[bytes], first: bool
                    ) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of members (by rising size) of different components whose
    bitmaps leave room for a link: all, or each member's first."""
    maps = [np.frombuffer(b, np.uint64) for b in bits]
    level = np.array([len(m) for m in maps])
    hi = np.searchsorted(n, n * DEN // NUM, side="right")
    tables: dict[int, tuple[int, np.ndarray]] = {}
    left, right = [], []
    for i in range(len(n) - 1):
        a, b = i + 1, int(hi[i])
        if a >= b:
            continue
        words = int(level[i])
        if words not in tables:
            # Sizes in range have this many words of bitmap, or twice as many.
            end = int(np.searchsorted(level, 2 * words, side="right"))
            tables[words] = i, np.stack([folded(m, words) for m in maps[i:end]])
        base, rows = tables[words]
        j = np.arange(a, b)
        j = j[c[j] != c[i]]
        if not len(j):
            continue
        differ = np.bitwise_count(rows[j - base] ^ rows[i - base]).sum(axis=1, dtype=np.int64)
        j = j[differ <= n[i] + n[j] - 2 * pair_overlap(n[i], n[j])]
        j = j[:1] if first else j
        left.append(np.full(len(j), i))
        right.append(j)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def pairs_across(mixed_: DataFrame, first: bool) -> DataFrame:
    """Feasible pairs of sets of different components in the same list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m in batch.column("m"):
                flat = m.values
                n, k, c = (flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64)
                           for f in ("n", "key", "component"))
                i, j = feasible_across(n, c, flat.field("bits").to_pylist(), first)
                if len(i):
                    yield pair_batch([k[i]], [k[j]])

    return mixed_.mapInArrow(run, "a long, b long").distinct()


#: Rows of keys up to which a side is broadcast (about 25 MB); beyond, it is shuffled.
BROADCAST_ROWS = 1_000_000


def restricted(df: DataFrame, keys: DataFrame, on: str | list = "key") -> DataFrame:
    """``df`` inner-joined with ``keys`` (distinct): without a shuffle of ``df``
    where the keys are few enough to be broadcast, else with one."""
    few = keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(keys) if few else keys, on)


def linked(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The pairs of keys whose sets are similar enough, compared in full."""
    ends = written(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(),
                   "pair-ends")
    texts = restricted(texts, ends)
    ta = texts.select(F.col("key").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("key").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(ta, "a").join(tb, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        for batch in batches:
            for rows, _ in slices(batch, "ta"):
                keep = []
                columns = [rows.column("a").to_pylist(), rows.column("b").to_pylist(),
                           rows.column("ta").cast(pa.binary()).to_pylist(),
                           rows.column("tb").cast(pa.binary()).to_pylist()]
                if len(sets) > 2_000:
                    sets.clear()
                fresh = {}
                for a, b, x, y in zip(*columns, strict=True):
                    fresh.update({k: t for k, t in ((a, x), (b, y)) if k not in sets})
                sets.update(zip(fresh, shingle_sets(list(fresh.values()), width), strict=True))
                for a, b in zip(columns[0], columns[1], strict=True):
                    x, y = sets[a], sets[b]
                    x, y = (x, y) if len(x) <= len(y) else (y, x)
                    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    inter = int((y[at] == x).sum())
                    keep.append(DEN * inter >= NUM * (len(x) + len(y) - inter))
                yield rows.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return written(both.mapInArrow(run, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links)
    of every row of ``docs`` (doc_id, text).

    Documents with equal sets are one vertex. Documents without words have the
    empty set and stay alone. Rows that repeat a doc_id are rows of one
    document with a set each; their component is the smallest id either
    reaches. Rows with a NULL doc_id have a set, but are linked only through
    rows of equal sets that have an id. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    first = first_pass(docs, width)
    sizes = first.where("block IS NULL").select("doc_id", "h", "n", "key")
    levels = spark.sparkContext.broadcast(frequency_levels(first.where("block IS NOT NULL")))
    lists = distinct_lists(index_lists(postings(docs, levels, width)))
    pairs = written(first_pairs(lists), "pairs")
    # Texts of the sets that have a partner at all, one document for each set.
    classes = sizes.where("n > 0").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.min_by("h", "doc_id").alias("rep_h"))
    wanted = classes.join(keys_of(lists), "key").select(
        "key", F.col("rep").alias("doc_id"), F.col("rep_h").alias("h"))
    wanted = written(wanted, "partners")
    texts = written(restricted(docs, wanted, ["doc_id", "h"]).select("key", "text"), "partner-texts")
    bitmaps = parity_bitmaps(texts, width)
    links = linked(with_room(pairs, bitmaps), texts, width)
    components = connected_components(links)
    for first_only in (True, False):
        across = mixed_lists(lists, components, bitmaps)
        if not across.limit(1).count():
            break
        more = written(pairs_across(across, first_only).join(pairs, ["a", "b"], "left_anti"), "pairs")
        found = linked(more, texts, width)
        pairs = pairs.unionByName(more)
        if found.limit(1).count():
            links = links.unionByName(found)
            components = connected_components(links)
    # Component of every set, then its smallest document.
    sets = classes.join(components, F.col("key") == F.col("id"), "left").select(
        "key", "rep", F.coalesce("component", "key").alias("component"))
    smallest = sets.groupBy("component").agg(F.min("rep").alias("component_id"))
    label = sets.join(smallest, "component").select(F.col("key").alias("_key"), "component_id")
    return sizes.join(label, (F.col("key") == F.col("_key")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"))


def keys_of(lists: DataFrame) -> DataFrame:
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join(batch.column("keys").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.frombuffer(raw, np.int64)))],
                                             names=["key"])

    return lists.select("keys").mapInArrow(unpack, "key long").distinct()


def keep_one(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """``docs`` with one document of each component: the smallest doc_id. Rows
    that repeat an id and its text are kept once; rows without an id and
    documents without words are all kept."""
    groups = near_duplicates(docs, width).select(F.col("doc_id").alias("_doc"), "component_id")
    groups = written(groups, "components-of-documents")
    kept = docs.join(groups.where("_doc <> component_id").select("_doc").distinct(),
                     F.col("doc_id") == F.col("_doc"), "left_anti")
    again = groups.where("_doc IS NOT NULL").groupBy("_doc").count().where("count > 1")
    if not again.limit(1).count():
        return kept
    once = kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
    return once.unionByName(kept.where("doc_id IS NULL"))


def op7_jaccard(spark, sf_dir: str) -> DataFrame:
    """Similarity classes of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, sha256(array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
                    FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach AS (SELECT doc_id AS v, doc_id AS c FROM d
          UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.v
          WHERE reach.c < links.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT v, min(c) AS component_id FROM reach GROUP BY v) r ON r.v = d.doc_id
"""
