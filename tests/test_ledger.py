"""Runs that take effect once, as a whole: cut off after each write and started again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from crowding import schemas
from crowding.operators import quality
from crowding.plans import runs
from crowding.plans.ledger import COMMITTED, PUBLISHED, Ledger
from crowding.plans.queries import corrected
from crowding.session import scratch_path
from crowding.sources import lake

GATES = (
    quality.GateSpec(**{**quality.RIDERSHIP_GATE.__dict__, "min_rows": 1}),
    quality.GateSpec(**{**quality.APT_GATE.__dict__, "min_rows": 1}),
)
AS_OF = dt.date(2001, 10, 3)
RUN_TIME = "2001-10-03T06:00:00.000000Z"


class Killed(Exception):
    pass


class Killer:
    """Raises after the n-th write to the lake or a stage."""

    def __init__(self, monkeypatch):
        self.left, self.count = None, 0
        for name in ("write_partitioned", "write_table"):
            monkeypatch.setattr(lake, name, self._after(getattr(lake, name)))

    def _after(self, write):
        def run(*a, **b):
            write(*a, **b)
            self.count += 1
            if self.left is not None:
                self.left -= 1
                if self.left == 0:
                    raise Killed

        return run


def _state(spark, root):
    """Everything that a reader of the lake can see."""
    p = lake.LakePaths(root)
    tables = ((p.ridership, schemas.RIDERSHIP_MONTHS), (p.hours, schemas.HOURS), (p.csi, schemas.CSI), (p.apt, schemas.APT))
    seen = []
    for path, schema in tables:
        rows = lake.read_table(spark, path, schema)
        doubles = {f.name for f in schema.fields if f.dataType.simpleString() == "double"}
        rounded = rows.select(*[F.round(c, 6).alias(c) if c in doubles else c for c in rows.columns])
        seen.append(sorted(map(str, rounded.collect())))
    audit = []
    if lake.exists(spark, p.audit):
        audit = sorted(map(str, lake.read_table(spark, p.audit, schemas.AUDIT).collect()))
    return seen, audit


def _run(spark, inputs, root, run_id="sep-corrected"):
    raw = corrected(inputs.raw, dt.date(2001, 9, 1), dt.date(2001, 10, 1))
    runs.run_month(spark, raw, inputs.apt, root, AS_OF, "sep", GATES, run_time=RUN_TIME, run_id=run_id)


@pytest.fixture(scope="module")
def history(spark, inputs):
    """A root with the full history, and a way to have it anew."""

    def build():
        root = scratch_path(spark, "t-ledger")
        runs.build_history(spark, inputs.raw, inputs.apt, inputs.stations, root, 2000)
        return root

    return build


def test_a_run_killed_after_each_write_equals_a_clean_one(spark, inputs, history, monkeypatch):
    clean, root = history(), history()
    killer = Killer(monkeypatch)
    before = _state(spark, root)
    _run(spark, inputs, clean)
    writes = killer.count
    want = _state(spark, clean)
    assert want[0] != before[0] and len(want[1]) == 2
    ledger, landing_writes = Ledger(spark, root), 0
    for n in range(1, writes + 1):
        state = ledger.state("sep-corrected")
        if state == PUBLISHED:
            break
        # After the commit a restart only has the publishing to finish.
        killer.left = n if state is None else n - committed_at
        with pytest.raises(Killed):
            _run(spark, inputs, root)
        killer.left = None
        if ledger.state("sep-corrected") is None:
            assert _state(spark, root) == before, f"visible after write {n}"
            committed_at = n
    assert n > 8 and ledger.state("sep-corrected") in (COMMITTED, PUBLISHED)
    _run(spark, inputs, root)
    assert _state(spark, root) == want and landing_writes == 0
    # A run that starts again after its end adds nothing, and leaves no stage behind.
    _run(spark, inputs, root)
    assert _state(spark, root) == want and ledger.state("sep-corrected") == PUBLISHED
    assert killer.count > 0 and ledger.recover() == []


def test_another_run_finishes_what_was_committed(spark, inputs, history, monkeypatch):
    root = history()
    killer = Killer(monkeypatch)
    ledger = Ledger(spark, root)
    real = Ledger._publish
    monkeypatch.setattr(Ledger, "_publish", lambda *a: (_ for _ in ()).throw(Killed()))
    with pytest.raises(Killed):
        _run(spark, inputs, root, "first")
    monkeypatch.setattr(Ledger, "_publish", real)
    assert ledger.state("first") == COMMITTED
    killer.left = 1  # the next run is cut off at once, after it has recovered the first
    assert ledger.rows().count() == 1
    killer.left = None
    assert ledger.recover() == ["first"] and ledger.state("first") == PUBLISHED
    _, audit = _state(spark, root)
    assert len(audit) == 2 and all("first" in a for a in audit)


def test_failed_gates_and_runs_without_an_id(spark, inputs, history):
    root = history()
    for _ in range(2):
        with pytest.raises(quality.GateFailure):
            runs.run_month(spark, inputs.raw, inputs.apt, root, AS_OF, "sep", run_id="floor", run_time=RUN_TIME)
    audit = lake.read_table(spark, lake.LakePaths(root).audit, schemas.AUDIT).collect()
    assert sorted((r["dataset"], r["run_id"]) for r in audit) == [("apt", "floor"), ("ridership", "floor")]
    # The floor was lowered: the same id runs, and its failure is replaced.
    runs.run_month(spark, inputs.raw, inputs.apt, root, AS_OF, "sep", GATES, run_id="floor", run_time=RUN_TIME)
    audit = lake.read_table(spark, lake.LakePaths(root).audit, schemas.AUDIT).collect()
    assert sorted((r["status"], r["run_id"]) for r in audit) == [("success", "floor")] * 2
    runs.run_month(spark, inputs.raw, inputs.apt, root, AS_OF, "sep", GATES, run_time=RUN_TIME)
    assert lake.read_table(spark, lake.LakePaths(root).audit, schemas.AUDIT).count() == 4
