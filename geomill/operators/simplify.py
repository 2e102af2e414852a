"""Outlines with fewer vertices: borders that neighbours share stay shared, and nothing crosses that did not cross before.

A ring is cut into arcs at its nodes, the vertices where not all rings of a coverage go on alike. Equal arcs are one row, however many rings run along them and in whichever
direction, so each is simplified once and neighbours still fit. A simplified arc is a list of spans, each a chord in place of the vertices between its ends. Chords
that meet another span, or that leave a vertex of another arc on their other side, are split again at their farthest vertex until none is left. Spans meet in cells,
never all with all; only new spans are tested in a round.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomill.operators.outline import DEEPEST, FAN, MOST, ROOT, SIDES, index, segments_touch, side_of, size_of, with_cells
from geomill.operators.rasterize import POLYGONS
from geomill.sources.tables import staged

CORNERS = "array<struct<x:double,y:double>>"
FEW = 256  # features that a task puts into a batch of results
GENTLE = 6  # rounds that split a span at one vertex; later ones give it all its vertices back


def _away(points: np.ndarray, a: int, b: int) -> np.ndarray:
    """How far the vertices between two lie from the line through these."""
    line, off = points[b] - points[a], points[a + 1 : b] - points[a]
    norm = np.hypot(*line)
    return np.abs(line[0] * off[:, 1] - line[1] * off[:, 0]) / norm if norm else np.hypot(off[:, 0], off[:, 1])


def douglas_peucker(points: np.ndarray, tolerance: float, stay: tuple[int, ...] = ()) -> np.ndarray:
    """Which vertices stay: ends and those of `stay` always, and those farther than `tolerance` from the line between kept ones."""
    keep = np.zeros(len(points), bool)
    fixed = sorted({0, len(points) - 1, *stay})
    keep[fixed] = True
    spans = list(zip(fixed, fixed[1:], strict=False))
    while spans:
        a, b = spans.pop()
        if b - a < 2:
            continue
        away = _away(points, a, b)
        far = int(away.argmax())
        if away[far] > tolerance:
            keep[a + 1 + far] = True
            spans += [(a, a + 1 + far), (a + 1 + far, b)]
    return keep


def _first_kept(points: np.ndarray, tolerance: float) -> np.ndarray:
    """The vertices that an arc keeps at first; a closed one keeps a triangle at least."""
    stay: tuple[int, ...] = ()
    if len(points) > 3 and (points[0] == points[-1]).all():
        far = int(np.hypot(*(points - points[0]).T).argmax())
        line = points[far] - points[0]
        stay = (far, int(np.abs(line[0] * (points - points[0])[:, 1] - line[1] * (points - points[0])[:, 0]).argmax()))
    return np.flatnonzero(douglas_peucker(points, tolerance, stay))


def _split(points: np.ndarray, kept: np.ndarray, bad: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """The vertices kept after the spans in `bad` are split, and which spans are new."""
    more: list[int] = []
    for n in bad:
        a, b = int(kept[n]), int(kept[n + 1])
        more += range(a + 1, b) if whole else [a + 1 + int(_away(points, a, b).argmax())]
    now = np.union1d(kept, np.array(more, kept.dtype))
    old = set(zip(kept.tolist(), kept[1:].tolist(), strict=False))
    return now, np.array([s not in old for s in zip(now.tolist(), now[1:].tolist(), strict=False)], bool)


def _lists(a: pa.Array) -> list[np.ndarray]:
    flat = a.flatten()
    values = np.stack([flat.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y")], axis=1) if pa.types.is_struct(flat.type) else flat.to_numpy(zero_copy_only=False)
    return np.split(values, np.cumsum(a.value_lengths().to_numpy(zero_copy_only=False))[:-1]) if len(a) else []


def _arcs_out(batch: pa.RecordBatch, same: list[str], kept: list[np.ndarray], fresh: list[np.ndarray]) -> pa.RecordBatch:
    sizes = batch["points"].value_lengths().to_numpy(zero_copy_only=False)
    at = np.concatenate([k + start for k, start in zip(kept, np.cumsum(sizes) - sizes, strict=True)])
    ends = lambda lists: pa.array(np.append(0, np.cumsum([len(v) for v in lists])), pa.int32())
    corners = pa.ListArray.from_arrays(ends(kept), batch["points"].flatten().take(pa.array(at)))
    columns = [pa.ListArray.from_arrays(ends(kept), pa.array(np.concatenate(kept), pa.int32())), corners, pa.ListArray.from_arrays(ends(fresh), pa.array(np.concatenate(fresh), pa.bool_()))]
    return pa.RecordBatch.from_arrays([*(batch[c] for c in same), *columns], [*same, "kept", "corners", "fresh"])


def _rings(features: DataFrame, key: str, on: tuple[str, ...]) -> DataFrame:
    """key, on, part, ring, points, closed: every ring without vertices that repeat the one before; closed ones have three or more and no coordinate that is no
    number."""
    rings = features.select(key, *on, F.posexplode("polygons").alias("part", "_p")).select(key, *on, "part", F.posexplode("_p").alias("ring", "_r")).filter("_r IS NOT NULL")
    rings = rings.withColumn("points", F.filter("_r", lambda p, i: (i == 0) | (p != F.get("_r", i - 1))))
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    closed = (F.size("points") > 3) & (F.get("points", F.lit(0)) == F.element_at("points", -1)) & F.forall("points", lambda p: finite(p["x"]) & finite(p["y"]))
    return rings.select(key, *on, "part", "ring", F.when(F.coalesce(closed, F.lit(False)), F.col("points")).otherwise(F.col("_r")).alias("points"), F.coalesce(closed, F.lit(False)).alias("closed"))


def _arcs(rings: DataFrame, key: str, on: tuple[str, ...]) -> DataFrame:
    """key, on, part, ring, nth, arc, flipped, points: the arcs of closed rings, points in the direction that all rings share."""
    name = [key, *on, "part", "ring"]
    count = F.size("points") - 1
    ways = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(i.alias("k"), F.get("points", i).alias("p"), F.get("points", i + 1).alias("next"), F.get("points", F.when(i > 0, i - 1).otherwise(count - 1)).alias("last")))
    corners = rings.select(*name, F.explode(ways).alias("_w")).select(*name, "_w.*")
    both = corners.select(*on, "p", F.explode(F.array("next", "last")).alias("to"))
    nodes = both.distinct().groupBy(*on, "p").agg(F.count("*").alias("_n")).filter("_n <> 2").drop("_n")
    cuts = corners.join(nodes, [*on, "p"]).groupBy(*name).agg(F.array_sort(F.collect_list("k")).alias("cuts"))
    cut = rings.join(cuts, name, "left").withColumn("_open", F.slice("points", 1, F.size("points") - 1))
    smallest = F.array((F.array_position("_open", F.array_min("_open")) - 1).cast("int"))
    cut = cut.withColumn("cuts", F.coalesce("cuts", smallest)).withColumn("_twice", F.concat("_open", "_open")).withColumn("_n", F.size("_open"))

    def arc(a: Column, i: Column) -> Column:
        length = F.pmod(F.coalesce(F.get("cuts", i + 1), F.get("cuts", F.lit(0))) - a, F.col("_n"))
        return F.slice("_twice", a + 1, F.when(length == 0, F.col("_n")).otherwise(length) + 1)

    arcs = cut.select(*name, F.posexplode(F.transform("cuts", arc)).alias("nth", "_a")).withColumn("_b", F.reverse("_a"))
    arcs = arcs.withColumn("flipped", F.col("_b") < F.col("_a")).withColumn("points", F.when(F.col("flipped"), F.col("_b")).otherwise(F.col("_a")))
    return arcs.select(*name, "nth", F.sha2(F.to_json("points"), 256).alias("arc"), "flipped", "points")


def _spans(kept: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """on, arc, n, i, j, fresh, x0, y0, x1, y1: the spans of arcs."""
    at = lambda n: F.struct(F.get("kept", n).alias("i"), F.get("kept", n + 1).alias("j"), F.get("fresh", n).alias("fresh"), *(F.get("corners", n + d)[c].alias(f"{c}{d}") for d in (0, 1) for c in "xy"))
    return kept.select(*on, "arc", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("kept") - 2), at)).alias("n", "_s")).select(*on, "arc", "n", "_s.*")


def _met(spans: DataFrame, on: tuple[str, ...], most: int) -> DataFrame:
    """on, arc, n: spans with vertices to give back that share with a fresh span (or are one that shares) more than a common end."""
    coarse = with_cells(spans, F.lit(ROOT))
    counts = coarse.groupBy(*on, "cell_x", "cell_y").agg(F.count("*").alias("_n"), F.max("fresh").alias("_any")).filter("_any")
    more = F.greatest(F.lit(0), F.least(F.lit(DEEPEST), F.ceil(F.log(F.col("_n") / F.lit(float(most))) / F.log(F.lit(float(FAN)))))).cast("int")
    dealt = coarse.hint("merge").join(counts.select(*on, "cell_x", "cell_y", more.alias("more")), [*on, "cell_x", "cell_y"])
    fine = with_cells(dealt, size_of(F.col("more")), F.struct("cell_x", "cell_y"), F.pow(F.lit(float(FAN)), F.col("more")).cast("long"))
    cells, names = [*on, "more", "cell_x", "cell_y"], ("arc", "n", "i", "j", *SIDES)
    one, two = (fine.filter(which).select(*cells, *(F.col(c).alias(f"{p}_{c}") for c in names)) for p, which in (("a", "fresh"), ("b", "true")))
    a, b = ({c: F.col(f"{p}_{c}") for c in names} for p in "ab")
    same = lambda s, t: (a[f"x{s}"] == b[f"x{t}"]) & (a[f"y{s}"] == b[f"y{t}"])
    shared = reduce(lambda m, n: m + n, (same(s, t).cast("int") for s in (0, 1) for t in (0, 1)))

    def folds(s: int, t: int) -> Column:
        v, p, q = (a[f"x{s}"], a[f"y{s}"]), (a[f"x{1 - s}"], a[f"y{1 - s}"]), (b[f"x{1 - t}"], b[f"y{1 - t}"])
        ahead = (p[0] - v[0]) * (q[0] - v[0]) + (p[1] - v[1]) * (q[1] - v[1]) > 0
        return same(s, t) & (side_of(*p, *v, *q) == 0) & ahead

    fold = reduce(lambda m, n: m | n, (folds(s, t) for s in (0, 1) for t in (0, 1)))
    bad = F.when(shared == 0, segments_touch(a, b)).otherwise((shared == 2) | fold)
    other, long = (a["arc"] != b["arc"]) | (a["n"] != b["n"]), lambda s: s["j"] - s["i"] > 1
    pairs = one.hint("merge").join(two, cells).filter(other & (long(a) | long(b)) & bad)
    sides = F.array(*(F.struct(s["arc"].alias("arc"), s["n"].alias("n"), long(s).alias("long")) for s in (a, b)))
    return pairs.select(*on, F.explode(sides).alias("_s")).filter("_s.long").select(*on, "_s.arc", "_s.n").distinct()


def _passed(spans: DataFrame, arcs: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """on, arc, n: fresh spans with the first vertex of another arc between the chord and the vertices that it stands for. Places meet spans by
    the boxes of these vertices, in cells as wide as the box or wider."""
    cut = spans.filter("fresh AND j - i > 1").select(*on, "arc", "n", "i", "j").join(arcs, [*on, "arc"])
    side = F.slice("points", F.col("i") + 1, F.col("j") - F.col("i") + 1)
    of = lambda how, c: how(F.transform(side, lambda p: p[c]))
    boxes = cut.select(*on, "arc", "n", "i", "j", *(of(how, c).alias(f"{name}_{c}") for c in "xy" for name, how in (("low", F.array_min), ("high", F.array_max))))
    extent = F.greatest(F.col("high_x") - F.col("low_x"), F.col("high_y") - F.col("low_y"))
    level = F.when(extent > 0, F.greatest(F.lit(0), F.least(F.lit(DEEPEST), F.floor(F.log(F.lit(ROOT) / extent) / F.log(F.lit(float(FAN))))))).otherwise(DEEPEST).cast("int")
    boxes = staged(boxes.withColumn("level", level), "span-boxes")
    over = lambda c: F.sequence(index(F.col(f"low_{c}"), c, size_of(F.col("level"))), index(F.col(f"high_{c}"), c, size_of(F.col("level"))))
    boxes_in = boxes.withColumn("cell_x", F.explode(over("x"))).withColumn("cell_y", F.explode(over("y")))
    levels = [r.level for r in boxes.select("level").distinct().collect()]  # DEEPEST + 1 at most
    places = arcs.select(*on, F.col("arc").alias("other"), F.get("points", F.lit(0))["x"].alias("x"), F.get("points", F.lit(0))["y"].alias("y"))
    cell = lambda k: F.struct(F.lit(k).alias("level"), *(index(F.col(c), c, F.lit(ROOT / FAN**k)).alias(f"cell_{c}") for c in "xy"))
    asked = places.withColumn("_c", F.explode(F.array(*map(cell, sorted(levels)))) if levels else F.lit(None).cast("struct<level:int,cell_x:bigint,cell_y:bigint>"))
    asked = asked.select(*places.columns, "_c.*")
    near = boxes_in.join(asked, [*on, "level", "cell_x", "cell_y"]).filter("arc <> other AND x BETWEEN low_x AND high_x AND y BETWEEN low_y AND high_y")
    near = near.select(*on, "arc", "n", "i", "j", "x", "y").distinct().join(arcs, [*on, "arc"])
    x, y, p = F.col("x"), F.col("y"), lambda i: F.get("points", i)

    def crossed(n: Column, k: Column) -> Column:
        s, t = p(k), p(F.when(k == F.col("j"), F.col("i")).otherwise(k + 1))
        return n + F.when((s["y"] > y) != (t["y"] > y), (x < (t["x"] - s["x"]) * (y - s["y"]) / (t["y"] - s["y"]) + s["x"]).cast("int")).otherwise(0)

    ends = reduce(lambda m, n: m | n, ((p(F.col(c))["x"] == x) & (p(F.col(c))["y"] == y) for c in "ij"))
    held = near.filter(~ends & (F.aggregate(F.sequence("i", "j"), F.lit(0), crossed) % 2 == 1))
    return held.select(*on, "arc", "n").distinct()


def simplify(features: DataFrame, tolerance: float = 0.01, key: str = "asdf_id", on: tuple[str, ...] = (), most: int = MOST) -> DataFrame:
    """key, on, polygons: the features (key, on, polygons; a row each) of each coverage (those that agree in `on`) by Douglas-Peucker, with topology kept.

    Borders shared vertex by vertex stay shared. No two simplified outlines cross, touch or run along each other where they did not before, and no part or hole
    comes to lie on another side of a line. A ring keeps three vertices. What crosses already stays as it is at that place. A ring that meets no other begins
    at its smallest vertex. Open rings, those with fewer than four points and those with a coordinate that is no number are left as they are; repeated vertices go, as do parts without rings; null
    and empty polygons stay. `most`: spans of a cell before finer cells are used."""
    rings = staged(_rings(features, key, on), "rings")
    cut = staged(_arcs(rings.filter("closed"), key, on), "cut-rings")
    arcs = staged(cut.groupBy(*on, "arc").agg(F.any_value("points").alias("points")), "arcs")
    same = [*on, "arc"]
    fields = [f"`{c}` {arcs.schema[c].dataType.simpleString()}" for c in same]
    schema = ", ".join([*fields, "kept array<int>", f"corners {CORNERS}", "fresh array<boolean>"])

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                kept = [_first_kept(p, tolerance) for p in _lists(batch["points"])]
                yield _arcs_out(batch, same, kept, [np.ones(len(k) - 1, bool) for k in kept])

    def go_on(whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    done = [_split(p, k, b, whole) for p, k, b in zip(*(_lists(batch[c]) for c in ("points", "kept", "bad")), strict=True)]
                    yield _arcs_out(batch, same, [k for k, _ in done], [f for _, f in done])

        return run

    kept, rounds = staged(arcs.mapInArrow(begin, schema), "kept"), 0
    while True:
        spans = staged(_spans(kept, on), "spans")
        bad = _met(spans, on, most).unionByName(_passed(spans, arcs, on)).groupBy(*same).agg(F.array_sort(F.collect_set("n")).alias("bad"))
        bad = staged(bad, "bad-spans")
        if bad.isEmpty():
            break
        rounds += 1
        split = kept.select(*same, "kept").join(bad, same).join(arcs, same).mapInArrow(go_on(rounds > GENTLE), schema)
        rest = kept.join(bad, same, "left_anti").withColumn("fresh", F.transform("fresh", lambda f: F.lit(False)))
        kept = staged(rest.unionByName(split), "kept")
    name = [key, *on, "part", "ring"]
    along = F.when(F.col("flipped"), F.reverse("corners")).otherwise(F.col("corners"))
    in_order = lambda at, what: F.transform(F.array_sort(F.collect_list(F.struct(at, what))), lambda s: s[what])
    pieces = cut.select(*name, "nth", *[c for c in same if c not in on], "flipped").join(kept, same).select(*name, "nth", F.slice(along, 1, F.size("corners") - 1).alias("piece"))
    made = pieces.groupBy(*name).agg(F.flatten(in_order("nth", "piece")).alias("r")).withColumn("r", F.concat("r", F.slice("r", 1, 1)))
    made = made.unionByName(rings.filter("NOT closed").select(*name, F.col("points").alias("r")))
    parts = made.groupBy(key, *on, "part").agg(in_order("ring", "r").alias("p"))
    whole = parts.groupBy(key, *on).agg(in_order("part", "p").alias("_made"))
    return features.select(key, *on, "polygons").join(whole, [key, *on], "left").select(key, *on, F.coalesce("_made", "polygons").alias("polygons"))


def _texts(points: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    """Vertices (x, y), and how many characters each takes in the coordinates' text."""
    x, y = (points.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
    return np.stack([x, y], axis=1), np.array([len(repr(a)) + len(repr(b)) + 6 for a, b in zip(x.tolist(), y.tolist(), strict=True)], np.int64)


def _fit(rings: list[np.ndarray], chars: list[np.ndarray], limit: int, step: float) -> tuple[list[np.ndarray], float]:
    """The vertices that stay of each ring of a feature, and the tolerance at which their text is within the limit."""
    k, now = 0, [np.arange(len(r)) for r in rings]
    while sum(int(c[n].sum()) for c, n in zip(chars, now, strict=True)) > limit and k * step < 90:
        k += 1
        stay = [np.flatnonzero(douglas_peucker(r, k * step)) if len(r) > 3 else np.arange(len(r)) for r in rings]
        now = [n if len(n) >= 4 else np.arange(len(r)) for n, r in zip(stay, rings, strict=True)]
        if sum(map(len, now)) <= 4 * len(rings):
            break
    return now, k * step


def limit_chars(df: DataFrame, limit: int = 8_000_000, step: float = 0.0001, key: str = "asdf_id") -> DataFrame:
    """key, polygons, tolerance: each feature by itself, ring by ring, simplified by 0, step, 2 * step, ... until the coordinates' text is within `limit`, or
    no vertex goes any more; null polygons stay. For display: neighbours may part and rings may cross, unlike in `simplify`. A task holds the
    vertices of one feature as numbers beside Spark's own batch."""

    def one(column: pa.ListArray) -> tuple[pa.ListArray, float]:
        if column.null_count:
            return column, 0.0
        parts = column.flatten()
        rings = parts.flatten()
        points = rings.flatten()
        sizes = rings.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        at = np.append(0, np.cumsum(sizes))
        cut = lambda v: np.split(v, at[1:-1]) if len(sizes) else []
        stay, tolerance = _fit(*map(cut, _texts(points)), limit, step)
        if not tolerance:
            return column, 0.0
        ends = lambda n: pa.array(np.append(0, np.cumsum(n)), pa.int32())
        kept = points.take(pa.array(np.concatenate([n + start for n, start in zip(stay, at[:-1], strict=True)])))
        made = pa.ListArray.from_arrays(ends([len(n) for n in stay]), kept)
        made = pa.ListArray.from_arrays(ends(parts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)), made)
        return pa.ListArray.from_arrays(ends([len(parts)]), made), tolerance

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, FEW):
                few = batch.slice(start, FEW)
                done = [one(few["polygons"].slice(k, 1)) for k in range(few.num_rows)]
                yield pa.RecordBatch.from_arrays([few[key], pa.concat_arrays([p.cast(few["polygons"].type) for p, _ in done]), pa.array([t for _, t in done], pa.float64())], [key, "polygons", "tolerance"])

    return df.select(key, "polygons").mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, polygons {POLYGONS}, tolerance double")
