"""Polygons whose rings cross, touch or fold back on themselves, found before they are stored.

Edges of one feature meet in the cells that they run through, so an outline of any length is compared with itself piece by piece.
Spark takes exploded rows for no larger than the file they come from, so the joins ask for sorted sides: none is broadcast through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomill.functions import geometry as G
from geomill.operators.outline import DEEPEST, FAN, MOST, ROOT, SIDES, segments_touch, side_of, size_of, with_cells
from geomill.sources.tables import staged


def numbered_edges(features: DataFrame, key: str) -> DataFrame:
    """key, part, ring, k, n, x0, y0, x1, y1: the edges of every ring in order, n of them; none for a vertex that repeats the one
    before it, none with a coordinate that is no number."""
    rings = features.select(key, F.posexplode("polygons").alias("part", "_p")).select(key, "part", F.posexplode("_p").alias("ring", "_r"))
    apart = F.filter("_r", lambda p, i: (i == 0) | (p != F.get("_r", i - 1)))
    edge = lambda i: F.struct(F.get("_r", i)["x"].alias("x0"), F.get("_r", i)["y"].alias("y0"), F.get("_r", i + 1)["x"].alias("x1"), F.get("_r", i + 1)["y"].alias("y1"))
    rings = rings.withColumn("_r", apart).filter("size(_r) > 1").withColumn("n", F.size("_r") - 1)
    edges = rings.select(key, "part", "ring", "n", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), edge)).alias("k", "_e")).select(key, "part", "ring", "k", "n", "_e.*")
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return edges.filter(finite("x0") & finite("y0") & finite("x1") & finite("y1"))


def _meeting(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """`crossing`, `touching`, `touching rings` or `spike` for what two edges of a feature do, null if it is in order."""
    same_part, same_ring = a["part"] == b["part"], (a["part"] == b["part"]) & (a["ring"] == b["ring"])
    gap = F.abs(a["k"] - b["k"])
    neighbours = same_ring & ((gap == 1) | (gap == a["n"] - 1))
    # neighbours share a vertex; they fold back if their other ends lie in one direction from it
    after = (a["x1"] == b["x0"]) & (a["y1"] == b["y0"])
    pick = lambda one, two: F.when(after, one).otherwise(two)
    vx, vy, px, py, qx, qy = pick(a["x1"], a["x0"]), pick(a["y1"], a["y0"]), pick(a["x0"], a["x1"]), pick(a["y0"], a["y1"]), pick(b["x1"], b["x0"]), pick(b["y1"], b["y0"])
    folds = (side_of(px, py, vx, vy, qx, qy) == 0) & ((px - vx) * (qx - vx) + (py - vy) * (qy - vy) > 0)
    ends = lambda c: ((c["x0"], c["y0"]), (c["x1"], c["y1"]))
    line = lambda c: (c["x0"], c["y0"], c["x1"], c["y1"])
    (p, q), (r, s) = (tuple(side_of(*line(of), *end) for end in ends(other)) for of, other in ((a, b), (b, a)))
    shared = lambda v: F.least(F.greatest(a[f"{v}0"], a[f"{v}1"]), F.greatest(b[f"{v}0"], b[f"{v}1"])) - F.greatest(F.least(a[f"{v}0"], a[f"{v}1"]), F.least(b[f"{v}0"], b[f"{v}1"]))
    along = (p == 0) & (q == 0) & (r == 0) & (s == 0) & ((shared("x") > 0) | (shared("y") > 0))
    through = (p * q < 0) & (r * s < 0)
    return F.when(neighbours, F.when(folds, "spike")).when(along | through, "crossing").when(same_ring, "touching").when(same_part, "touching rings")


def crossing_issues(features: DataFrame, key: str = "asdf_id", level: int = 0, most: int = MOST) -> DataFrame:
    """key, issues: sorted names of what the edges of a feature (key, polygons) do to each other, of the features where they do.

    `crossing`: two edges cross or run along each other; `touching`: a ring meets itself in a point; `touching rings`: rings of one part meet in a
    point; `spike`: a ring turns back on itself. Parts may meet in points. Cells are of `level`, or finer where a feature has more
    than `most` edges in one."""
    edges = staged(numbered_edges(features, key), "numbered-edges")  # read four times; how they are made stays out of the plans of what follows
    coarse = with_cells(edges, F.lit(ROOT / FAN**level))
    counts = coarse.groupBy(key, "cell_x", "cell_y").agg(F.count("*").alias("_n"))
    more = F.greatest(F.lit(0), F.least(F.lit(DEEPEST - level), F.ceil(F.log(F.col("_n") / F.lit(float(most))) / F.log(F.lit(float(FAN)))))).cast("int")
    dealt = coarse.hint("merge").join(counts.select(key, "cell_x", "cell_y", more.alias("more")), [key, "cell_x", "cell_y"])
    fine = staged(with_cells(dealt, size_of(F.col("more") + level), F.struct("cell_x", "cell_y"), F.pow(F.lit(float(FAN)), F.col("more")).cast("long")), "edge-cells")
    cells, names = [key, "more", "cell_x", "cell_y"], ("part", "ring", "k", "n", *SIDES)
    one, two = (fine.select(*cells, *(F.col(c).alias(f"{p}_{c}") for c in names)) for p in "ab")
    a, b = ({c: F.col(f"{p}_{c}") for c in names} for p in "ab")
    first = F.struct(a["part"], a["ring"], a["k"]) < F.struct(b["part"], b["ring"], b["k"])
    met = one.hint("merge").join(two, cells).filter(first & segments_touch(a, b)).select(key, _meeting(a, b).alias("issue")).filter("issue IS NOT NULL")
    return met.groupBy(key).agg(F.array_sort(F.collect_set("issue")).alias("issues"))


def all_issues(features: DataFrame, key: str = "asdf_id") -> DataFrame:
    """key, issues: those of `geometry_issues` and of `crossing_issues`, sorted, of every feature."""
    features = staged(features.select(key, "polygons"), "features")
    own = features.select(key, G.geometry_issues(F.col("polygons")).alias("_own"))
    both = own.join(crossing_issues(features, key).hint("merge"), key, "left")
    return both.select(key, F.array_sort(F.concat("_own", F.coalesce("issues", F.array().cast("array<string>")))).alias("issues"))
