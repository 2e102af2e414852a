"""Batches merged into a store: what they do not touch stays, and a merge that is cut off can be finished or run again."""

from __future__ import annotations

import pytest

from geomill.operators import store

COLUMNS = store.EXTRACTS


def batch(spark, keys, value):
    return spark.createDataFrame([(k, "d", "mean", "1", value) for k in keys], COLUMNS)


def rows(spark, root):
    return sorted(((r.hash, r.value) for r in store.read_store(spark, root, COLUMNS).collect()), key=str)


def files(root):
    return {str(p.relative_to(root)): (p.stat().st_mtime_ns, p.stat().st_size) for p in (root / "rows").rglob("part-*")}


def test_only_touched_folders_change(spark, tmp_path):
    keys = [f"k{i}" for i in range(400)]
    store.merge_extracts(str(tmp_path), batch(spark, keys, 1.0), digits=1)
    before = files(tmp_path)
    assert len({f.split("/")[1] for f in before}) == 16
    store.merge_extracts(str(tmp_path), batch(spark, ["k7", "new"], 2.0), digits=1)
    after = files(tmp_path)
    changed = {f.split("/")[1] for f, _ in set(before.items()) ^ set(after.items())}
    assert 1 <= len(changed) <= 2
    assert rows(spark, str(tmp_path)) == sorted([(k, 2.0 if k == "k7" else 1.0) for k in keys] + [("new", 2.0)])
    store.merge_extracts(str(tmp_path), batch(spark, [], 2.0), digits=1)
    assert files(tmp_path) == after


@pytest.mark.parametrize("moved", [0, 1, 3])
@pytest.mark.parametrize("deleted", [False, True])
def test_a_merge_cut_off_is_finished(spark, tmp_path, monkeypatch, moved, deleted):
    keys, root = [f"k{i}" for i in range(60)], str(tmp_path)
    store.merge_extracts(root, batch(spark, keys, 1.0), digits=1)
    real, done = store._Folders.move, []

    def cut(self, prefix):
        if len(done) == moved:
            if deleted:
                self.delete(f"rows/{prefix}")
            raise KeyboardInterrupt
        done.append(prefix)
        real(self, prefix)

    monkeypatch.setattr(store._Folders, "move", cut)
    with pytest.raises(KeyboardInterrupt):
        store.merge_extracts(root, batch(spark, keys[:30], 2.0), digits=1)
    monkeypatch.undo()
    expected = sorted((k, 2.0 if k in keys[:30] else 1.0) for k in keys)
    if moved == 1:
        store.merge_extracts(root, batch(spark, keys[:30], 2.0), digits=1)
    assert rows(spark, root) == expected and not (tmp_path / "merged").exists()


def test_folders_that_were_never_whole_are_dropped(spark, tmp_path):
    root = str(tmp_path)
    store.merge_extracts(root, batch(spark, ["a", "b", None], 1.0))
    batch(spark, ["a"], 9.0).withColumnRenamed("hash", "prefix").write.partitionBy("prefix").parquet(f"{root}/merged")
    (tmp_path / "merged" / "_SUCCESS").unlink()
    assert rows(spark, root) == sorted([("a", 1.0), ("b", 1.0), (None, 1.0)], key=str)
    store.merge_extracts(root, batch(spark, [None], 3.0))
    assert rows(spark, root) == sorted([("a", 1.0), ("b", 1.0), (None, 3.0)], key=str)


def test_features_in_a_store(spark, tmp_path):
    new = lambda *r: spark.createDataFrame(r, "hash string, boundary string, properties string")
    store.merge_features(str(tmp_path), new(("h", "npl_adm1_gadm28", "a"), ("i", "npl_adm1_gadm28", "b")))
    store.merge_features(str(tmp_path), new(("h", "npl_adm2_gadm28", "c"), ("h", "npl_adm1_gadm28", "d")))
    got = {r.hash: (r.datasets, r.tags, r.properties) for r in store.read_store(spark, str(tmp_path), store.FEATURES).collect()}
    assert got["h"][0] == ["npl_adm1_gadm28", "npl_adm2_gadm28"] and got["h"][2] == {"npl_adm1_gadm28": "d", "npl_adm2_gadm28": "c"}
    assert got["i"] == (["npl_adm1_gadm28"], ["adm1", "adm1_gadm28", "gadm28", "npl"], {"npl_adm1_gadm28": "b"})
