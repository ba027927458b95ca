"""Free-text sites into entities: great-circle clusters where coordinates are known, fuzzy names elsewhere."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import EARTH_RADIUS_KM, haversine_km
from tidemark.functions.text import entity_key, filled
from tidemark.operators.components import connected_components
from tidemark.operators.numbering import numbered
from tidemark.session import checkpointed

DISTANCE_KM, SIMILARITY = 1.0, 0.85
#: Cubes further apart than REACH along an axis can't be linked; cubes are paired in blocks of BLOCK along each axis.
REACH, BLOCK = 2, 16
#: Names are compared in chunks of about CHUNK, so long as those are no more than MOST_CHUNKS.
CHUNK, MOST_CHUNKS = 20_000, 64
#: So many links of similar names fit into one task.
FEW_LINKS = 4_000_000
#: Names of up to so many characters are compared as the bits of a word.
WORD = 64
#: How many of a letter's occurrences have a bit of their own, by code point modulo 32: 64 bits in all.
PLACES = (4, 4, 1, 1, 2, 4, 1, 1, 2, 3, 1, 1, 3, 2, 3, 3, 2, 1, 4, 3, 3, 3, 1, 1, 1, 1, 1, 1, 2, 1, 1, 2)


def _cell(lat: Column, lon: Column, edge: float) -> Column:
    """The cube of space a point on the sphere lies in; poles and the date line are nothing special there."""
    y, x = F.radians(lat), F.radians(lon)
    axes = (F.cos(y) * F.cos(x), F.cos(y) * F.sin(x), F.sin(y))
    return F.struct(*[F.floor(a * EARTH_RADIUS_KM / edge).alias(n) for a, n in zip(axes, "xyz")])


def point_clusters(points: DataFrame, km: float = DISTANCE_KM) -> DataFrame:
    """(lat, lon, component) of distinct points; points within ``km`` are linked, clusters are what links reach.

    Cubes are small enough that all points of one are within ``km``, so a crowded cube is one node and no pairs are
    made inside. Two neighbouring cubes are linked if their points nearest to each other's centre are within ``km``;
    only for cubes where those are not, points are compared in pairs.
    """
    edge = km / 3**0.5 * (1 - 1e-6)
    placed = checkpointed(points.select("lat", "lon", _cell(F.col("lat"), F.col("lon"), edge).alias("cell")))
    cells = placed.groupBy("cell").agg(F.min(F.struct("lat", "lon")).alias("some"))
    # neighbouring cubes meet in blocks of BLOCK cubes a side: a cube goes to its block, and once to each block within reach
    axis = lambda n, by: F.floor((F.col(f"cell.{n}") + by) / BLOCK)
    near = cells.select("cell", "some", *[F.array_distinct(F.array(axis(n, -REACH), axis(n, REACH))).alias(n) for n in "xyz"])
    for n in "xyz":
        near = near.withColumn(n, F.explode(n))
    own = cells.select("cell", F.col("some").alias("a_some"), F.xxhash64(*[axis(n, 0) for n in "xyz"]).alias("block"))
    near = near.select(F.col("cell").alias("other"), F.col("some").alias("b_some"), F.xxhash64("x", "y", "z").alias("block"))
    beside = F.col("other") > F.col("cell")
    for n in "xyz":
        beside = beside & (F.abs(F.col(f"other.{n}") - F.col(f"cell.{n}")) <= REACH)
    pairs = checkpointed(own.alias("o").join(near.alias("n"), (F.col("o.block") == F.col("n.block")) & beside).select("cell", "other", "a_some", "b_some"))

    def nearest(mine: str, goal: str, out: str) -> DataFrame:
        """The point of the cube ``mine`` nearest to some point of the other one, for each pair."""
        met = pairs.select("cell", "other", F.col(mine).alias("m"), F.col(goal).alias("goal")).join(placed.select(F.col("cell").alias("m"), "lat", "lon"), "m")
        far = haversine_km(F.col("lat"), F.col("lon"), F.col("goal.lat"), F.col("goal.lon"))
        return met.groupBy("cell", "other").agg(F.min(F.struct(far.alias("d"), "lat", "lon")).alias(out))

    near = nearest("cell", "b_some", "a").join(nearest("other", "a_some", "b"), ["cell", "other"])
    close = haversine_km(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")) <= km
    tested = checkpointed(near.select("cell", "other", (close | (F.col("a.d") <= km) | (F.col("b.d") <= km)).alias("linked")))
    unsure = tested.filter("not linked").select("cell", "other")
    left = placed.select("cell", F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
    right = placed.select(F.col("cell").alias("other"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    within = haversine_km(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2")) <= km
    late = unsure.join(left, "cell").join(right, "other").filter(within).select("cell", "other").distinct()
    links = tested.filter("linked").select("cell", "other").unionByName(late)
    found = connected_components(cells.select(F.col("cell").alias("node")), links.select(F.col("cell").alias("a"), F.col("other").alias("b")))
    return placed.join(found.withColumnRenamed("node", "cell"), "cell").select("lat", "lon", "component")


def common_name(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, name): the most frequent non-empty name of a group, the first seen on a tie."""
    counted = rows.filter(filled(F.col("name")).isNotNull()).groupBy(*keys, "name").agg(F.count("*").alias("n"), F.min("row_key").alias("first"))
    return counted.groupBy(*keys).agg(F.max_by("name", F.struct("n", (-F.col("first")).alias("first"))).alias("name"))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The names of a partition as one row: positions, lengths, letters as 64 bits, and the texts."""
    table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
    if table is None:
        return
    pos, keys = table.column("pos").to_numpy().astype(np.int64), table.column("key").to_pylist()
    lens = np.array([len(k) for k in keys], np.int64)
    flat = np.frombuffer("".join(keys).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(keys)), lens)
    counts = np.bincount(row * 32 + flat % 32, minlength=len(keys) * 32).reshape(-1, 32)
    letters, at = np.zeros(len(keys), np.uint64), 0
    for letter, places in enumerate(PLACES):
        for n in range(places):
            letters |= (counts[:, letter] > n).astype(np.uint64) << np.uint64(at)
            at += 1
    packed = {"pos": pos, "lens": lens, "letters": letters}
    data = {c: pa.array([v.tobytes()], pa.binary()) for c, v in packed.items()} | {"text": pa.array(["".join(keys).encode("utf-8", "surrogatepass")], pa.binary())}
    ends = {"chunk": TaskContext.get().partitionId(), "shortest": int(lens.min()), "longest": int(lens.max())}
    yield pa.RecordBatch.from_pydict({c: pa.array([v], pa.int32()) for c, v in ends.items()} | data)


class _Chunk:
    """The names of one row of ``_feature_rows``; ``side`` is the prefix of its columns."""

    def __init__(self, row: dict, side: str):
        self.pos, self.lens = np.frombuffer(row[f"{side}_pos"], np.int64), np.frombuffer(row[f"{side}_lens"], np.int64)
        self.letters = np.frombuffer(row[f"{side}_letters"], np.uint64)
        self.text, self.ends = row[f"{side}_text"].decode("utf-8", "surrogatepass"), np.cumsum(self.lens)

    def key(self, i: int) -> str:
        return self.text[self.ends[i] - self.lens[i] : self.ends[i]]

    def spelt(self) -> np.ndarray:
        """A row of code points modulo 32 for each name, those of its first WORD characters, 32 behind its end."""
        flat = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.arange(min(WORD, int(self.lens.max())))
        inside = at < self.lens[:, None]
        return np.where(inside, flat[np.where(inside, (self.ends - self.lens)[:, None] + at, 0)] % 32, 32).astype(np.uint8)

    def places(self) -> np.ndarray:
        """Where a name has each of them, as bits; a last column of zeros for what isn't there."""
        out, spelt = np.zeros((len(self.lens), 33), np.uint64), self.spelt()
        for n in range(spelt.shape[1]):
            out[np.arange(len(out)), spelt[:, n]] |= np.uint64(1 << n)
        out[:, 32] = 0
        return out


def _near_letters(x: _Chunk, y: _Chunk, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in x and y of names whose letters differ in no more places than similar names' may.

    Names of x that agree in length and in the most telling letter bits are compared together, and only with names of y
    that don't differ too much in those bits already.
    """
    said = np.concatenate([x.letters[:: max(1, len(x.letters) // 2000)], y.letters[:: max(1, len(y.letters) // 2000)]])
    share = np.array([((said >> np.uint64(b)) & np.uint64(1)).mean() for b in range(64)])
    telling = np.argsort(np.abs(share - 0.5), kind="stable")[: max(0, min(12, int(math.log2(len(x.letters) / 8 + 1))))]
    brief = lambda bits: sum((((bits >> np.uint64(b)) & np.uint64(1)).astype(np.uint16) << np.uint16(i) for i, b in enumerate(telling)), np.zeros(len(bits), np.uint16))
    brief_x, brief_y = brief(x.letters), brief(y.letters)
    order = np.lexsort((brief_x, x.lens))
    lens, briefs = x.lens[order], brief_x[order]
    starts = np.flatnonzero(np.r_[True, (lens[1:] != lens[:-1]) | (briefs[1:] != briefs[:-1])])
    size = None
    for start, end in zip(starts, np.r_[starts[1:], len(order)]):
        if lens[start] != size:
            size = lens[start]
            apart = _apart(size + y.lens, similarity)
            fits = np.flatnonzero(apart >= np.abs(y.lens - size))
            most, letters, shown = np.minimum(apart[fits], 64).astype(np.uint8), y.letters[fits], brief_y[fits]
        met = np.flatnonzero(np.bitwise_count(shown ^ briefs[start]) <= most)
        theirs, limit = letters[met], most[met]
        step = max(1, (1 << 18) // max(1, len(met)))
        for at in range(start, end, step):
            own = order[at : min(at + step, end)]
            found = np.flatnonzero(np.bitwise_count(x.letters[own][:, None] ^ theirs) <= limit)
            if len(found):
                i, j = np.divmod(found, len(met))
                yield own[i], fits[met[j]]


def _apart(total: np.ndarray, similarity: float) -> np.ndarray:
    """How many characters of similar names, of so many together, may be left unmatched."""
    return total - 2 * np.ceil(total * (similarity / 2) - 1e-9).astype(np.int64)


def _in_order(x: _Chunk, y: _Chunk) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """How many characters, modulo 32, of the names at places of x and y stand in the same order in both at most. Of names
    longer than WORD it says no more than their lengths do."""
    spelt, places = x.spelt(), y.places()

    def count(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        most = np.minimum(x.lens[i], y.lens[j])
        short = np.flatnonzero(np.maximum(x.lens[i], y.lens[j]) <= WORD)
        i, j = i[short], j[short]
        whole = np.uint64(2**64 - 1) >> (WORD - y.lens[j]).astype(np.uint64)
        rest = whole
        for n in range(int(x.lens[i].max(initial=0))):
            both = rest & places[j, spelt[i, n]]
            rest = ((rest + both) | (rest - both)) & whole
        most[short] = y.lens[j] - np.bitwise_count(rest)
        return most

    return count


def _compared(similarity: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            x, y, same = _Chunk(row, "l"), _Chunk(row, "r"), row["l_chunk"] == row["r_chunk"]
            in_order, pending, n = _in_order(x, y), [], 0

            def told() -> pa.RecordBatch:
                i, j = (np.concatenate(c) for c in zip(*pending))  # noqa: B023
                total = x.lens[i] + y.lens[j]  # noqa: B023
                enough = total - 2 * in_order(i, j) <= _apart(total, similarity)  # noqa: B023
                both = ((int(x.pos[a]), x.key(a), int(y.pos[b]), y.key(b)) for a, b in zip(i[enough], j[enough]))  # noqa: B023
                pairs = [(p, q) if p > q else (q, p) for p, k, q, o in both if SequenceMatcher(None, *((k, o) if p > q else (o, k))).ratio() >= similarity]
                return pa.RecordBatch.from_pydict({c: pa.array([pair[n] for pair in pairs], pa.int64()) for n, c in enumerate(("later", "earlier"))})

            for i, j in _near_letters(x, y, similarity):
                if same:
                    i, j = i[(once := x.pos[i] > y.pos[j])], j[once]
                if len(i):
                    pending.append((i, j))
                    n += len(i)
                if n > 200_000:
                    yield told()
                    pending, n = [], 0
            if pending:
                yield told()

    return tiles


def similar_names(names: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(later, earlier) positions of names with SequenceMatcher ratio >= similarity, the later name first.

    names: key, pos (distinct). Every pair is compared, in tiles of two chunks of names of like length; nothing is shuffled for
    it. Of T characters in both names M >= similarity T / 2 match, in order. So the counts of their letters differ by
    T - 2 M at most, which is tested on bits, and the longest common subsequence has M characters; the ratio itself is
    computed once for each pair that is left.
    """
    sized = names.select("pos", "key", F.length("key").alias("size"))
    n = names.count()
    parts = min(MOST_CHUNKS, max(-(-n // CHUNK), min(8, -(-n // 2000)), 1))
    fields = "chunk int, shortest int, longest int, pos binary, lens binary, letters binary, text binary"
    chunks = checkpointed(sized.repartitionByRange(parts, "size", "pos").select("pos", "key").mapInArrow(_feature_rows, fields))
    side = lambda s: chunks.select(*[F.col(c).alias(f"{s}_{c}") for c in chunks.columns])
    reach = F.col("l_longest") * (2 - similarity) >= F.col("r_shortest") * similarity - 1e-6
    tiles = side("l").hint("shuffle_replicate_nl").join(side("r"), (F.col("l_chunk") <= F.col("r_chunk")) & reach)
    return tiles.mapInArrow(_compared(similarity), "later bigint, earlier bigint")


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pos, leader) of the names that join a leader, from all links, in order of position."""
    links = pa.Table.from_batches(batches, pa.schema([("later", pa.int64()), ("earlier", pa.int64())])).sort_by([("later", "ascending"), ("earlier", "ascending")])
    leader: dict[int, int] = {}
    for b in links.to_batches(100_000):
        for later, earlier in zip(b.column("later").to_pylist(), b.column("earlier").to_pylist()):
            if later not in leader and earlier not in leader:
                leader[later] = earlier
    yield pa.RecordBatch.from_pydict({"pos": pa.array(leader.keys(), pa.int64()), "leader": pa.array(leader.values(), pa.int64())})


def name_leaders(names: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(key, pos, leader): in order of position, a name joins the first leader it resembles or becomes a leader.

    Up to FEW_LINKS links are followed in order by one task. More are without a sequential task: in each round every name is
    settled whose earlier look-alikes are, the first open one at least.
    """
    links = checkpointed(similar_names(names, similarity))
    if links.limit(FEW_LINKS + 1).count() <= FEW_LINKS:
        joined = links.repartition(1).mapInArrow(_settled, "pos bigint, leader bigint")
        return checkpointed(names.select("key", "pos").join(joined, "pos", "left").select("key", "pos", F.coalesce("leader", "pos").alias("leader")))
    state = checkpointed(names.select("key", "pos", F.lit(None).cast("bigint").alias("leader")))
    while True:
        open_names = state.filter("leader is null")
        seen = links.join(state.select(F.col("pos").alias("earlier"), F.col("leader").alias("other")), "earlier").groupBy(F.col("later").alias("pos")).agg(
            F.min(F.when(F.col("other") == F.col("earlier"), F.col("earlier"))).alias("first_leader"), F.min(F.when(F.col("other").isNull(), F.col("earlier"))).alias("first_open")
        )
        settled = F.when(F.col("first_leader").isNotNull() & (F.col("first_open").isNull() | (F.col("first_open") > F.col("first_leader"))), F.col("first_leader")).when(
            F.col("first_leader").isNull() & F.col("first_open").isNull(), F.col("pos")
        )
        moved = open_names.join(seen, "pos", "left").select("key", "pos", settled.alias("leader"))
        state = checkpointed(state.filter("leader is not null").unionByName(moved))
        if not state.filter("leader is null").limit(1).count():
            return state


def resolve_entities(rows: DataFrame, km: float = DISTANCE_KM, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(entities, assignments) of rows with row_key (unique), name, latitude, longitude.

    entities: entity_id, name, latitude, longitude, resolution_method; assignments: row_key, entity_id. A lone latitude
    or longitude counts as none. Rows with coordinates make clusters, numbered by their first row, whose place is the
    mean of their distinct points. Other rows go by name; rows without one are entities of their own. Null and empty
    names are no names; repeated points and names weigh in the name's count only. Empty input gives empty tables.
    """
    known = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    placed = rows.filter(known).select("row_key", "name", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    points = checkpointed(point_clusters(placed.select("lat", "lon").distinct(), km))
    members = placed.join(points, ["lat", "lon"])
    middle = points.groupBy("component").agg(F.avg("lat").alias("latitude"), F.avg("lon").alias("longitude"))
    first = members.groupBy("component").agg(F.min("row_key").alias("first_row"))
    spots = first.join(middle, "component").join(common_name(members, ["component"]), "component", "left")

    other = checkpointed(rows.filter(~known).select("row_key", "name", entity_key(F.col("name")).alias("key")))
    names = checkpointed(other.filter("key is not null").groupBy("key").agg(F.min("row_key").alias("pos"), F.min_by("name", "row_key").alias("name")))
    leaders = name_leaders(names.select("key", "pos"), similarity)
    nameless = other.filter("key is null").select("row_key")
    first_nameless = F.lit(nameless.agg(F.min("row_key")).first()[0]).cast("bigint")

    none = F.lit(None)
    kinds = (
        spots.select(F.lit(0).alias("phase"), "first_row", F.lit(0).cast("bigint").alias("own"), "name", "latitude", "longitude", F.lit("coordinate").alias("resolution_method"), F.struct("component").alias("c"), none.cast("bigint").alias("leader")),
        names.join(leaders.filter("leader = pos").select("pos"), "pos").select(F.lit(1).alias("phase"), F.col("pos").alias("first_row"), F.lit(0).cast("bigint").alias("own"), "name", none.cast("double").alias("latitude"), none.cast("double").alias("longitude"), F.lit("name").alias("resolution_method"), none.alias("c"), F.col("pos").alias("leader")),
        nameless.select(F.lit(1).alias("phase"), first_nameless.alias("first_row"), F.col("row_key").alias("own"), none.cast("string").alias("name"), none.cast("double").alias("latitude"), none.cast("double").alias("longitude"), F.lit("unresolved").alias("resolution_method"), none.alias("c"), none.cast("bigint").alias("leader")),
    )
    entities = checkpointed(numbered(reduce(DataFrame.unionByName, kinds), "entity_id", "phase", "first_row", "own"))
    by_place = members.join(entities.filter("phase = 0").select(F.col("c.component").alias("component"), "entity_id"), "component").select("row_key", "entity_id")
    by_name = other.filter("key is not null").join(leaders.select("key", "leader"), "key").join(entities.filter("leader is not null").select("leader", "entity_id"), "leader").select("row_key", "entity_id")
    alone = entities.filter("resolution_method = 'unresolved'").select(F.col("own").alias("row_key"), "entity_id")
    columns = ("entity_id", "name", "latitude", "longitude", "resolution_method")
    return entities.select(*columns), checkpointed(by_place.unionByName(by_name).unionByName(alone))
