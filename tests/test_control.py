"""Control rows of many generations: bounded listings, replays of long ago, names and roots that stay with their owner."""

import pytest
from pyspark.sql import functions as F

from sluicegate.operators.registry import Field, TableSchema
from sluicegate.options import IngestOptions
from sluicegate.plans.fixtures import record_frames, registration_frames, registration_json
from sluicegate.plans.flush import FlushFailed, StaleGeneration, Store, flush_generation
from sluicegate.schemas import FRAMES, REGISTRY_PARTS
from sluicegate.session import local_rows
from sluicegate.sinks import control
from sluicegate.sinks.owner import RootTaken, claim, release
from sluicegate.sinks.targets import CatalogTarget, FolderTarget, NameTaken, SchemaChanged
from sluicegate.sinks.views import publish, view_name

X = (Field("x", "long"),)


def _register(spark, seq, table, fields=X, namespace=("n",)):
    return registration_frames(spark, [(seq, registration_json(table, namespace, fields))])


def _records(spark, table, *rows):
    name = table.encode()
    head = b"\x02" + len(name).to_bytes(2, "big") + name
    return local_rows(spark, [(seq, None, head + f'{{"x":{x}}}'.encode()) for seq, x in rows], FRAMES)


def _part(spark, gen, table, seq, kind="long"):
    return local_rows(spark, [(table, seq, seq, None, ["n"], [{"name": "x", "type": kind, "required": True}], gen)], REGISTRY_PARTS)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def often(monkeypatch):
    monkeypatch.setattr(control, "EVERY", 2)


def test_two_hundred_generations_of_control_rows(spark, root):
    store, listed = Store(root), {}
    for gen in range(200):
        # The same 20 tables register again and again, with another type in the second half.
        store.registry_parts.replace(_part(spark, gen, f"t{gen % 20}", gen, "long" if gen < 100 else "string"), gen)
        if gen % control.EVERY == control.EVERY - 1:
            store.registry_parts.put_together(spark, gen)
        if gen in (60, 199):
            known = store.registry(spark)
            listed[gen] = len(known.inputFiles())
            assert known.count() == 20
    assert max(listed.values()) <= control.EVERY + 1
    assert len(store.registry_parts.recent_gens(spark)) <= 2 * control.EVERY + 1
    types = {r["table"]: r["fields"][0]["type"] for r in store.registry(spark).collect()}
    assert set(types.values()) == {"string"}
    # A replay of long ago, whose merged folders are gone, sees what was registered then and nothing later.
    for gen in (3, 47, 110):
        then = store.registry(spark, gen).collect()
        assert len(then) == min(gen + 1, 20) and max(r["last_seq"] for r in then) == gen
        assert {r["fields"][0]["type"] for r in then if r["last_seq"] < 100} <= {"long"}
    assert store.registry_parts.read(spark).count() == 200
    assert [r["gen"] for r in store.registry_parts.read_one(spark, 5).collect()] == [5]


def test_a_round_that_was_cut_off_changes_nothing(spark, root):
    store = Store(root)
    for gen in range(6):
        store.registry_parts.replace(_part(spark, gen, f"t{gen}", gen), gen)
    before = _rows(store.registry(spark))
    store.registry_parts.put_together(spark, 3)
    control.remove(spark, f"{store.registry_parts.path}/merged/upto=3/{control.COMPLETE}")
    assert store.registry_parts.merged_upto(spark) is None and _rows(store.registry(spark)) == before
    store.registry_parts.put_together(spark, 5)
    assert store.registry_parts.merged_upto(spark) == 5 and _rows(store.registry(spark)) == before


@pytest.mark.parametrize("kind", ["folder", "catalog"])
def test_closed_generations(spark, root, often, kind):
    namespace = ("n", root.rsplit("-", 1)[1])
    target = FolderTarget(root) if kind == "folder" else CatalogTarget(root, location=f"{root}/warehouse")
    options, store = IngestOptions(root, publish_views=True), Store(root)
    schema = TableSchema("a", namespace, X)
    for gen in range(5):
        frames = _records(spark, "a", (10 * gen + 1, gen), (10 * gen + 2, gen))
        if gen == 0:
            frames = frames.unionByName(_register(spark, 0, "a", namespace=namespace))
        flush_generation(frames, gen, target, options)
        assert spark.table(view_name(schema)).count() == 2 * (gen + 1)
    assert store.closed_upto(spark) == 3
    again = flush_generation(_records(spark, "a", (1, 0), (2, 0)), 0, target, options)
    assert (again.rows, again.already_committed) == ({"a": 2}, ("a",))
    assert _rows(spark.table(view_name(schema))) == sorted([(g,) for g in range(5)] * 2)
    # A generation that was never seen may not slip in where readers take everything as committed.
    with pytest.raises(StaleGeneration):
        flush_generation(_records(spark, "a", (1, 0)), -7, target, options)
    assert store.ledger.read(spark).where("table IS NOT NULL").count() == 5


def test_an_open_generation_is_not_put_together(spark, root, often):
    options, target = IngestOptions(root), FolderTarget(root)
    flush_generation(_register(spark, 0, "a").unionByName(_records(spark, "a", (1, 1))), 0, target, options)
    wider = _register(spark, 5, "a", (*X, Field("y", "long", False)))
    with pytest.raises(FlushFailed):
        flush_generation(wider.unionByName(_records(spark, "a", (6, 1))), 1, target, options)
    flush_generation(_register(spark, 7, "b").unionByName(_records(spark, "b", (8, 1))), 2, target, options)
    assert Store(root).closed_upto(spark) is None


def test_a_place_stays_with_the_table_that_was_written_first(spark, root):
    namespace, options = ("raw", root.rsplit("-", 1)[1]), IngestOptions(root)
    target = CatalogTarget(root, location=f"{root}/warehouse")
    flush_generation(_register(spark, 5, "Case", namespace=namespace).unionByName(_records(spark, "Case", (6, 1))), 0, target, options)
    frames = _register(spark, 1, "case", namespace=namespace).unionByName(_records(spark, "case", (7, 2)))
    for _ in range(2):
        with pytest.raises(FlushFailed) as failed:
            flush_generation(frames, 1, target, options)
        assert isinstance(failed.value.__cause__, NameTaken)
    flush_generation(_records(spark, "Case", (8, 3)), 2, target, options)
    (name,) = [r["place"] for r in Store(root).places.read(spark).collect()]
    assert _rows(spark.table(name).select("x", "_gen")) == [(1, 0), (3, 2)]


def test_views_of_folders_fold_names(spark, root):
    namespace, options, target = ("n", root.rsplit("-", 1)[1]), IngestOptions(root), FolderTarget(root)
    frames = _register(spark, 0, "Case", namespace=namespace).unionByName(_register(spark, 0, "case", namespace=namespace))
    flush_generation(frames.unionByName(_records(spark, "Case", (1, 1))).unionByName(_records(spark, "case", (2, 2))), 0, target, options)
    ledger = Store(root).ledger
    first = publish(spark, target, TableSchema("Case", namespace, X), ledger)
    assert publish(spark, target, TableSchema("Case", namespace, X), ledger) == first and _rows(spark.table(first)) == [(1,)]
    with pytest.raises(NameTaken):
        publish(spark, target, TableSchema("case", namespace, X), ledger)


def test_one_more_table_is_one_more_write(spark, root):
    def jobs(n_tables, kind):
        folder = f"{root}/{kind}{n_tables}"
        target = FolderTarget(folder) if kind == "folder" else CatalogTarget(folder, location=f"{folder}/warehouse")
        namespace, names = (kind, f"{root.rsplit('-', 1)[1]}x{n_tables}"), [f"t{i}" for i in range(n_tables)]
        texts = [(0, registration_json(n, namespace, X)) for n in names]
        frames = registration_frames(spark, texts)
        for n in names:
            # Each table sets a record aside.
            frames = frames.unionByName(_records(spark, n, (1, 1), (2, '"no"')))
        frames = spark.createDataFrame(frames.toArrow()).coalesce(1)
        begun = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
        report = flush_generation(frames, 0, target, IngestOptions(folder))
        assert report.rows == dict.fromkeys(names, 1) and report.rejected == n_tables
        return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs() - begun

    assert jobs(9, "folder") - jobs(3, "folder") <= 6 + 2
    # A catalog table with rejects is read once more for them.
    assert jobs(9, "catalog") - jobs(3, "catalog") <= 2 * 6 + 2


def test_rejects_leave_the_table_folder_when_the_generation_is_closed(spark, root):
    options, target = IngestOptions(root), FolderTarget(root)
    frames = _register(spark, 0, "a").unionByName(_records(spark, "a", (1, 1), (2, '"no"')))
    bad = _register(spark, 0, "b", ()).unionByName(_records(spark, "b", (3, 1)))
    with pytest.raises(FlushFailed):
        flush_generation(frames.unionByName(bad), 0, target, options)
    schema = TableSchema("a", ("n",), X)
    assert target.has_rejects(spark, schema, 0)
    mended = frames.unionByName(_register(spark, 1, "b")).unionByName(_records(spark, "b", (3, 1)))
    report = flush_generation(mended, 0, target, options)
    assert (report.rows, report.rejected) == ({"a": 1, "b": 1}, 1) and not target.has_rejects(spark, schema, 0)
    assert [r["seq"] for r in Store(root).rejected(spark).collect()] == [2]


def test_one_job_a_root(spark, root):
    first, second = IngestOptions(root, owner="first"), IngestOptions(root, owner="second")
    claim(spark, first)
    claim(spark, first)
    with pytest.raises(RootTaken, match="belongs to job 'first'"):
        claim(spark, second)
    with pytest.raises(RootTaken):
        release(spark, second)
    release(spark, first)
    claim(spark, second)
    claim(spark, IngestOptions(root))


def test_changed_layout_is_refused_after_a_round(spark, root, often):
    options, target = IngestOptions(root), FolderTarget(root)
    for gen in range(4):
        frames = _records(spark, "a", (10 * gen + 1, gen))
        flush_generation(frames.unionByName(_register(spark, 0, "a")) if gen == 0 else frames, gen, target, options)
    assert Store(root).closed_upto(spark) is not None
    wider = _register(spark, 90, "a", (*X, Field("y", "long", False)))
    with pytest.raises(FlushFailed) as failed:
        flush_generation(wider.unionByName(_records(spark, "a", (91, 1))), 4, target, options)
    assert isinstance(failed.value.__cause__, SchemaChanged)
