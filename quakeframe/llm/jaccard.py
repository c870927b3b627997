"""N-gram Jaccard join by adaptive multi-match prefixes.

A document is the set of its distinct word shingles; two link when the Jaccard
similarity of their sets reaches the threshold. Equal sets form one class, and
classes are joined:

1. Every shingle is counted in a sketch over all documents; sketch level and
   hash give one total order, rare shingles first.
2. A class posts the prefix of its ordered set that any linked partner must hit
   at least L times. L is chosen by estimated cost: longer prefixes post more
   shingles, but require as many more shared ones before a pair is verified.
3. A second sketch tells shingles posted once, which are dropped before the
   shuffle. All classes that share a posted shingle come together at that shingle's
   smallest class, their leader, so a group of near copies meets at a few leaders,
   not in pairs.
4. Each member is first held against its leader alone: by shared prefix shingles
   and set sizes, then, with the texts, by the sets. Members linked with the leader
   are settled; two of them are connected already. Only the others are open and meet
   all members of the group, so a group of near copies costs as many comparisons as
   it has members. Groups are cut into chunks of bounded size, and tasks compare an
   open chunk with another chunk, again by prefixes and sizes before the sets. A pair
   with too few shared prefix shingles isn't verified, nor one that is connected
   already; the others are verified exactly.
5. Tasks emit a spanning forest of their links; connected components follow.

No list, partner or candidate is capped. Rows with a null key get their set size
and a null component; null texts and texts without words have an empty set and
are linked with nothing. Whole texts of any length count. Repeated rows keep their
own output row; texts under one key are linked one by one. Ties: the smallest key
names a component. Further columns of the input are ignored, but for those asked for.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.llm import blocks
from quakeframe.llm.words import mix64, shingle_hashes, slices, word_hashes
from quakeframe.session import materialize

#: The fewest and the most shared prefix shingles that a class may require.
MATCHES = (2, 5)
#: Cost of verifying a pair, in posted list entries.
VERIFY_COST = 20.0
#: Members and shingles of a chunk.
CHUNK_ROWS, CHUNK_SHINGLES = 256, 400_000
SKETCH_BITS = (16, 26)
#: Members of groups up to this number are broadcast to fetch their texts, and so are their groups' sizes (a few numbers each); more are joined by a shuffle.
BROADCAST_MEMBERS = 1_000_000
SLOT_BITS = 28


def text_sets(text: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    shingles, offsets = shingle_hashes(*word_hashes(text), size)
    return [np.unique(shingles[offsets[k] : offsets[k + 1]]) for k in range(len(offsets) - 1)]


def signature(own: np.ndarray) -> bytes:
    return hashlib.md5(own.tobytes(), usedforsecurity=False).digest()


def _slots(own: np.ndarray, bits: int, salt: int = 1) -> np.ndarray:
    """Slots of one sketch; sketches of other salts are independent."""
    return (mix64(own + np.uint64(salt)) >> np.uint64(64 - bits)).astype(np.int64)


def _needed(n: int, percent: int) -> int:
    """The least overlap with any linked partner."""
    return -(-percent * n // 100)


def _can_link(n: int, percent: int) -> bool:
    """Whether a set of n can link with another than itself."""
    return 100 * n >= percent * (n + 1)


def ordered_prefix(own: np.ndarray, levels: np.ndarray, noise: float, percent: int) -> tuple[np.ndarray, int]:
    """Positions in own, by the total order, of the chosen prefix; and L."""
    n = len(own)
    level = levels[_slots(own, int(math.log2(len(levels))))]
    order = np.lexsort((own, level))
    need = _needed(n, percent)
    most = min(MATCHES[1], need)
    fewest = min(MATCHES[0], most)
    length = n - need + most
    lists = np.cumsum(np.maximum(np.exp2(level[order[:length]] / 8.0) - 1 - noise, 0))
    costs = [lists[n - need + m - 1] * (1 + VERIFY_COST / m) + (n - need + m) for m in range(fewest, most + 1)]
    matches = fewest + int(np.argmin(costs))
    return order[: n - need + matches], matches


def _profile(docs: DataFrame, text: str, key: str, size: int, bits: int, mark: Column) -> DataFrame:
    """One row (key, n, sig, mark) a document, and the rows (block, data) of the shingle sketch."""
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kept = np.zeros(1 << bits, np.uint32), None
        for batch in batches:
            for part in slices(batch, "text"):
                sets = text_sets(part.column("text"), size)
                if sets:
                    np.add.at(counts, _slots(np.concatenate(sets), bits), np.uint32(1))
                kept = part.column("key").type
                n = len(sets)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array([len(s) for s in sets], pa.int64()), pa.array([signature(s) for s in sets], pa.binary()), part.column("mark"), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], names=names)
        if kept is not None:
            packed = blocks.pack(counts)
            n = len(packed)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, kept), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.array([b for b, _ in packed], pa.int64()), pa.array([d for _, d in packed], pa.binary())], names=names)

    names = ["key", "n", "sig", "mark", "block", "data"]
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text"), mark.cast("long").alias("mark")).mapInArrow(run, f"key {kind}, n long, sig binary, mark long, block long, data binary")


def _levels(sketch: DataFrame, bits: int) -> tuple[np.ndarray, float]:
    """Eight times log2 of each slot's count + 1, in a byte, and the usual count."""
    width = min(blocks.BLOCK, 1 << bits)
    levels = np.zeros(1 << bits, np.uint8)
    total = 0

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [blocks.unpack(d, width, np.uint32) for d in batch.column("data").to_pylist()]
            level = [np.minimum(np.rint(8 * np.log2(s + 1.0)), 255).astype(np.uint8).tobytes() for s in sums]
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(level, pa.binary()), pa.array([int(s.sum()) for s in sums], pa.int64())], names=["block", "level", "total"])

    rows = blocks.add_up(sketch, width, np.uint32).mapInArrow(quantise, "block long, level binary, total long").toPandas()  # 2^bits bytes
    for block, level, n in rows.itertuples(index=False):
        levels[block * width : (block + 1) * width] = np.frombuffer(level, np.uint8)
        total += n
    return levels, total / len(levels)


def _shared_slots(posted: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the slots that two postings at least fall into; a shingle posted once is mostly alone in its slot."""
    width = min(blocks.BLOCK, 1 << bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint8)
        for batch in batches:
            slot, n = np.unique(_slots(batch.column("token").to_numpy().view(np.uint64), bits, 2), return_counts=True)
            counts[slot] = np.minimum(counts[slot] + np.minimum(n, 2), 2)
        packed = blocks.pack(counts)
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in packed], pa.int64()), pa.array([d for _, d in packed], pa.binary())], names=["block", "data"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [np.packbits(blocks.unpack(d, width, np.uint8) > 1).tobytes() for d in batch.column("data").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(data, pa.binary())], names=["block", "data"])

    schema = "block long, data binary"
    out = np.zeros((1 << bits) // 8, np.uint8)
    rows = blocks.add_up(posted.select("token").mapInArrow(count, schema), width, np.uint8).mapInArrow(mark, schema).toPandas()  # 2^bits bits
    for block, data in rows.itertuples(index=False):
        out[block * width // 8 : (block + 1) * width // 8] = np.frombuffer(data, np.uint8)
    return out


class _Forest:
    """Union-find over the members of one comparison."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k


def linked_pairs(sets: list[np.ndarray], chunk: np.ndarray, levels: np.ndarray, noise: float, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets; with two chunks, of those from one to the other."""
    prefixes = [ordered_prefix(s, levels, noise, percent) for s in sets]
    size = np.array([len(s) for s in sets])
    matches = np.array([m for _, m in prefixes])
    base = size + (-percent * size // 100)  # prefix length less L
    flat = np.concatenate([s[at] for s, (at, _) in zip(sets, prefixes, strict=True)])
    lengths = np.array([len(at) for at, _ in prefixes])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    rank = np.arange(len(flat)) - np.repeat(starts[:-1], lengths)
    owner = np.repeat(np.arange(len(sets)), lengths)
    codes = np.unique(flat, return_inverse=True)[1]
    forest, out, two = _Forest(len(sets)), [], len(np.unique(chunk)) > 1
    place = np.full(codes.max() + 1, -1)
    for a in range(len(sets) - 1):
        own = slice(starts[a], starts[a + 1])
        place[codes[own]] = rank[own]
        rest = slice(starts[a + 1], len(flat))
        least = np.minimum(matches[a], matches[owner[rest]])
        hit = place[codes[rest]]
        good = (hit >= 0) & (hit < base[a] + least) & (rank[rest] < base[owner[rest]] + least)
        shared = np.bincount(owner[rest][good], minlength=len(sets))
        place[codes[own]] = -1
        near = np.nonzero(shared >= np.minimum(matches[a], matches))[0]
        near = near[(near > a) & (100 * np.minimum(size[near], size[a]) >= percent * np.maximum(size[near], size[a]))]
        if two:
            near = near[chunk[near] != chunk[a]]
        for b in near[np.argsort(-shared[near], kind="stable")]:
            x, y = forest.top(a), forest.top(int(b))
            if x == y:
                continue
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 100 * both >= percent * (size[a] + size[b] - both):
                forest.up[x] = y
                out.append((a, int(b)))
    return out


def _small(df: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(df) if few else df


def _tiles(members: DataFrame, few: bool, weight: Column, *columns: str) -> DataFrame:
    """Members (leader, key, open, ...) once for each pair of chunks (i, j) that their own chunk is in. Chunks hold open members
    or, with negative numbers, settled ones; a pair has an open chunk at least. Of few members, the groups' sizes are broadcast,
    so that a large group stays where its members are."""
    is_open = F.col("open")
    part = lambda x, on: F.coalesce(F.sum(F.when(on, x)), F.lit(0))
    count = lambda on: F.ceil(F.greatest(part(F.lit(1), on) / CHUNK_ROWS, part(weight, on) / CHUNK_SHINGLES)).cast("int")
    groups = members.groupBy("leader").agg(F.count(F.lit(1)).alias("rows"), count(is_open).alias("opened"), count(~is_open).alias("closed")).where("rows > 1 and opened > 0")
    number = F.pmod(F.xxhash64("key"), F.when(is_open, F.col("opened")).otherwise(F.col("closed"))).cast("int")
    opened = F.sequence(F.lit(0), F.col("opened") - 1)
    closed = F.when(F.col("closed") > 0, F.sequence(-F.col("closed"), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return (
        members.join(_small(groups.drop("rows"), few), "leader")
        .withColumn("chunk", F.when(is_open, number).otherwise(-1 - number))
        .withColumn("other", F.explode(F.when(is_open, F.concat(opened, closed)).otherwise(opened)))
        .select("leader", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), *columns)
    )


def _dealt(tiles: DataFrame) -> DataFrame:
    """Rows of a tile next to each other in one task."""
    return tiles.repartition("leader", "i", "j").sortWithinPartitions("leader", "i", "j")


def _groups(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[int, list[tuple]]]:
    """Leader and rows of each tile."""
    now, held = None, []
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("leader", "i", "j")), strict=True)
        for key, row in zip(keys, zip(*(batch.column(c).to_pylist() for c in columns), strict=True), strict=True):
            if key != now:
                if held:
                    yield now[0], held
                now, held = key, []
            held.append(row)
    if held:
        yield now[0], held


def _pairs(kept: set, kind: str) -> pa.RecordBatch:
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in kept], pa.int64()), pa.array([k for _, k in kept], types.get(kind))], names=["leader", "key"])


def _with_partner(tokens: list[list[int]], chunk: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Members that share the fewest required prefix shingles with another of fitting size."""
    lengths = np.array([len(t) for t in tokens])
    codes = np.unique(np.concatenate([np.asarray(t, np.int64) for t in tokens]), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(tokens)), lengths)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    two = len(np.unique(chunk)) > 1
    mark = np.zeros(codes.max() + 1, bool)
    found = np.zeros(len(tokens), bool)
    fewest = np.minimum(MATCHES[0], -(-percent * n // 100))
    for a in range(len(tokens) - 1):
        own = codes[starts[a] : starts[a + 1]]
        mark[own] = True
        shared = np.bincount(owner[starts[a + 1] :][mark[codes[starts[a + 1] :]]], minlength=len(tokens))
        mark[own] = False
        near = shared >= np.minimum(fewest, fewest[a])
        near &= 100 * np.minimum(n, n[a]) >= percent * np.maximum(n, n[a])
        if two:
            near &= chunk != chunk[a]
        if near.any():
            found |= near
            found[a] = True
    return np.nonzero(found)[0]


def links(docs: DataFrame, profile: DataFrame, levels: np.ndarray, noise: float, text: str, key: str, size: int, percent: int) -> DataFrame:
    """(a, b): signatures of linked classes, enough of them to connect what is connected."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((levels, noise))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_levels, own_noise = held.value
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                seen = set()
                for own in text_sets(part.column("text"), size):
                    if not _can_link(len(own), percent):
                        continue
                    sig = int.from_bytes(signature(own)[:8], "big", signed=True)
                    if sig not in seen:
                        seen.add(sig)
                        at, _ = ordered_prefix(own, own_levels, own_noise, percent)
                        tokens.append(own[at])
                        owners.append(np.full(len(at), sig))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(owners))], names=["token", "short"])

    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    posted = materialize(rows.select("text").mapInArrow(post, "token long, short long"), "postings")
    slot_bits = min(int(math.log2(len(levels))) + 4, SLOT_BITS)
    shared = spark.sparkContext.broadcast(_shared_slots(posted, slot_bits))

    def not_alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = _slots(batch.column("token").to_numpy().view(np.uint64), slot_bits, 2)
            yield batch.filter(pa.array((shared.value[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1))

    posted = posted.mapInArrow(not_alone, posted.schema)
    lists = posted.groupBy("token").agg(F.min("short").alias("leader"), F.max("short").alias("last")).where("leader <> last").drop("last")
    hits = materialize(posted.join(lists, "token").select("leader", "short", "token").distinct(), "hits")
    arrays = hits.groupBy("short").agg(F.collect_list("token").alias("tokens"))  # a prefix at most
    classes = profile.where(F.col("key").isNotNull()).groupBy("sig").agg(F.min("key").alias("key"), F.max("n").alias("n"))
    short = F.conv(F.hex(F.substring("sig", 1, 8)), 16, -10).cast("long").alias("short")
    fewest = lambda n: F.least(F.lit(MATCHES[0]), F.ceil(percent * F.col(n) / 100).cast("int"))
    posting = arrays.join(classes.select(short, "key", "n"), "short").where(F.size("tokens") >= fewest("n"))
    first = posting.select(F.col("short").alias("leader"), F.col("tokens").alias("first_tokens"), F.col("n").alias("first_n"))
    met = hits.select("leader", "short").distinct().join(posting, "short").join(first, "leader", "left")
    fits = 100 * F.least("n", "first_n") >= percent * F.greatest("n", "first_n")
    near = fits & (F.size(F.array_intersect("tokens", "first_tokens")) >= F.least(fewest("n"), fewest("first_n")))
    met = materialize(met.select("leader", "key", "n", "tokens", (~F.coalesce(near, F.lit(False))).alias("open"), (F.col("short") == F.col("leader")).alias("is_leader")), "met")
    kind = dict(rows.dtypes)["key"]
    few_met = met.count() <= BROADCAST_MEMBERS

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: set = set()
        for leader, rows_of in _groups(batches, ("chunk", "key", "n", "tokens")):
            chunk, keys, n, tokens = (list(c) for c in zip(*rows_of, strict=True))
            for k in _with_partner(tokens, np.array(chunk), np.array(n), percent):
                if (leader, keys[k]) not in kept:
                    kept.add((leader, keys[k]))
            if len(kept) >= 4096:
                yield _pairs(kept, kind)
                kept = set()
        if kept:
            yield _pairs(kept, kind)

    sifted = _dealt(_tiles(met, few_met, F.size("tokens"), "key", "n", "tokens")).mapInArrow(sift, f"leader long, key {kind}")
    sizes = classes.groupBy("key").agg(F.max("n").alias("n"))
    alone = met.where("not open").groupBy("leader").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("leader")
    stars = met.where("not open").join(_small(alone, few_met), "leader", "left_semi").select("leader", "key")
    members = materialize(stars.unionByName(sifted).distinct().join(sizes, "key"), "members")
    few = members.count() <= BROADCAST_MEMBERS
    with_text = lambda side: rows.join(_small(side, few), "key")

    # each member that may be near its leader against the leader
    salts = F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS), F.ceil(F.sum("n") / CHUNK_SHINGLES)).cast("int").alias("salts")
    star = members.join(stars, ["leader", "key"], "left_semi")
    star = star.join(_small(star.groupBy("leader").agg(salts), few), "leader")
    centre = met.where("is_leader").select("leader", "key").join(star.select("leader", "salts").distinct(), "leader")
    spokes = star.select("leader", F.pmod(F.xxhash64("key"), "salts").cast("int").alias("i"), F.lit(1).alias("j"), "key")
    spokes = spokes.unionByName(centre.select("leader", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("i"), F.lit(0).alias("j"), "key"))

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, centre_set, centre_name = None, None, None
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                columns = (part.column(c).to_pylist() for c in ("leader", "i", "j", "key"))
                for leader, i, j, name_of, own in zip(*columns, text_sets(part.column("text"), size), strict=True):
                    if (leader, i) != group:
                        group, centre_set = (leader, i), None
                    name = signature(own)
                    if j == 0:  # of the texts under the leader's key, the leader's own
                        if int.from_bytes(name[:8], "big", signed=True) == leader:
                            centre_set, centre_name = own, name
                    elif centre_set is not None and _can_link(len(own), percent):
                        both = len(np.intersect1d(own, centre_set, assume_unique=True))
                        out.append((leader, name_of, 100 * both >= percent * (len(own) + len(centre_set) - both), centre_name, name))
                if out:
                    types = (pa.int64(), part.column("key").type, pa.bool_(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["leader", "key", "linked", "a", "b"])

    dealt = with_text(spokes).select("leader", "i", "j", "key", "text").repartition("leader", "i").sortWithinPartitions("leader", "i", "j")
    held_up = materialize(dealt.mapInArrow(hold, f"leader long, key {kind}, linked boolean, a binary, b binary"), "stars")
    settled = held_up.groupBy("leader", "key").agg(F.min("linked").alias("linked"))
    tiles = _tiles(members.join(settled, ["leader", "key"], "left").withColumn("open", ~F.coalesce("linked", F.lit(False))), few, F.col("n"), "key")
    texts = with_text(tiles).select("leader", "i", "j", "chunk", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_levels, own_noise = held.value
        group, sets, chunk, names = None, [], [], []

        def close() -> pa.RecordBatch | None:
            pairs = linked_pairs(sets, np.array(chunk), own_levels, own_noise, percent) if len(sets) > 1 else []
            if pairs:
                return pa.RecordBatch.from_arrays([pa.array([names[p[k]] for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])
            return None

        for batch in batches:
            for part in slices(batch, "text"):
                keys = zip(*(part.column(c).to_pylist() for c in ("leader", "i", "j")), strict=True)
                for now, at, own in zip(keys, part.column("chunk").to_pylist(), text_sets(part.column("text"), size), strict=True):
                    if now != group:
                        if (done := close()) is not None:
                            yield done
                        group, sets, chunk, names = now, [], [], []
                    name = signature(own)
                    if name not in names[-1:] and _can_link(len(own), percent):
                        sets.append(own)
                        chunk.append(at)
                        names.append(name)
        if (done := close()) is not None:
            yield done

    return held_up.where("linked").select("a", "b").unionByName(_dealt(texts).mapInArrow(compare, "a binary, b binary"))


def components(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 5, percent: int = 80, mark: str | None = None) -> DataFrame:
    """One row a document: key, n_shingles (long) and component_id, the smallest key that links reach. If the column
    mark (long) is asked for, also mark and group, a binary that rows with words share just when links join them; keys that
    repeat may name several groups."""
    bits = min(max(math.ceil(math.log2(16 * max(1, docs.count()))), SKETCH_BITS[0]), SKETCH_BITS[1])
    table = materialize(_profile(docs, text, key, size, bits, F.col(mark) if mark else F.lit(None)), "profile")
    profile = table.where(F.col("sig").isNotNull()).select("key", "n", "sig", "mark")
    levels, noise = _levels(table.where(F.col("block").isNotNull()), bits)
    labels = blocks.components(links(docs, profile, levels, noise, text, key, size, percent))
    classes = profile.where(F.col("key").isNotNull() & (F.col("n") > 0)).groupBy("sig").agg(F.min("key").alias("first"))
    labelled = classes.join(labels.withColumnRenamed("node", "sig"), "sig", "left").select("sig", "first", F.coalesce("label", "sig").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component"))
    reached = labelled.join(smallest, "label").select("sig", "component", "label")
    empty = F.col("n") == 0
    joined = profile.join(reached, "sig", "left")
    component = F.when(F.col("key").isNull(), None).when(empty, F.col("key")).otherwise(F.col("component"))
    return joined.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), *([F.col("mark").alias(mark), F.col("label").alias("group")] if mark else []))


def duckdb_sql(size: int, percent: int) -> str:
    """The same components over documents, from all pairs that share a shingle."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= {size} THEN list_distinct(list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i+{size - 1}], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM d),
x AS (SELECT doc_id, md5(h) AS h, n FROM (SELECT doc_id, unnest(s) AS h, len(s) AS n FROM s)),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b USING (h) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= {percent} * (any_value(a.n) + any_value(b.n) - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT s.doc_id, len(s.s) AS n_shingles, min(b) AS component_id FROM s JOIN reach ON reach.a = s.doc_id GROUP BY ALL"""
