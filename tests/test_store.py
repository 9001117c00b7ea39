"""Replacing tables, locks, updates and the partitioned log, with failures put in at every step."""

import dataclasses
import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from plumbline.packs import PackRule
from plumbline.plans import reports
from plumbline.plans.onboarding import onboard
from plumbline.plans.runs import entity_reports, run_entity
from plumbline.schemas import RESULTS, RULE_MAPPINGS, RULES_GENERIC, VALIDATION_REQUEST
from plumbline.sources import store as store_module
from plumbline.sources.audit import append_run, check_new_run, recent_log
from plumbline.sources.registry import register_mappings, register_rules
from plumbline.sources.store import Store
from tests.test_flows import DAY, small_pack, store, things  # noqa: F401


class Crash(Exception):
    pass


def values(frame):
    return sorted(tuple(r) for r in frame.collect())


class Faulty(Store):
    """Fails before or after the n-th statement that changes the catalogue."""

    def arm(self, step, after):
        object.__setattr__(self, "left", [step, after])
        return self

    def _run(self, statement):
        step, after = self.left
        self.left[0] -= 1
        if step == 0 and not after:
            raise Crash
        super()._run(statement)
        if step == 0:
            raise Crash


@pytest.mark.parametrize("after", [False, True])
def test_replacing_shows_old_or_new_whatever_fails(spark, store, after):  # noqa: F811
    faulty = Faulty(spark, store.schema)
    store.overwrite("t", spark.range(3))
    store.set_order("t", ["id"])
    old, crashes = values(store.read("t")), 0
    for step in range(12):
        new = spark.range(10 * (step + 1), 10 * (step + 1) + 2).select("id", F.lit(step).alias(f"extra_{step}"))
        staged = store.stage("t", new)
        try:
            faulty.arm(step, after).swap(staged, "t")
        except Crash:
            crashes += 1
        assert values(store.read("t")) in (old, values(new))
        assert store.order("t") == ["id"] and "t" in store.tables()
        old = values(store.read("t"))
    assert crashes >= 3
    store.vacuum("t")
    assert values(store.read("t")) == old and len(store.versions("t")) <= 2


def test_a_planned_reader_outlives_a_replacement(spark, store):  # noqa: F811
    store.overwrite("t", spark.range(5))
    planned = store.read("t")
    store.overwrite("t", spark.range(7).select(F.col("id").cast("string").alias("other")))
    assert planned.count() == 5 and store.read("t").columns == ["other"]
    assert store.tables() == ["t"]
    store.discard("t")
    assert not store.exists("t") and not store.versions("t")


def test_tables_that_others_made_are_replaced_too(spark, store):  # noqa: F811
    spark.range(4).write.saveAsTable(store.name("plain"))
    assert store.version("plain") == "plain"
    store.overwrite("plain", spark.range(2))
    assert store.read("plain").count() == 2 and len(store.versions("plain")) == 2


def test_a_run_that_dies_before_the_swap_keeps_the_old_result(spark, store, monkeypatch):  # noqa: F811
    onboard(store, small_pack(), things(spark), DAY)
    run_entity(store, "things", "2024-01-01", dt.datetime(2024, 1, 1))
    before = values(store.read("things_dq"))

    def dies(self, *args, **kwargs):
        raise Crash

    monkeypatch.setattr(Store, "_show", dies)
    with pytest.raises(Crash):
        run_entity(store, "things", "2024-01-01", dt.datetime(2024, 1, 2))
    monkeypatch.undo()
    assert values(store.read("things_dq")) == before and store.read(RESULTS).count() == 3
    run_entity(store, "things", "2024-01-01", dt.datetime(2024, 1, 2))
    assert store.read(RESULTS).count() == 6


# onboarding -------------------------------------------------------------------


def ordered_pack():
    return dataclasses.replace(small_pack(), order_by=("k",))


@pytest.mark.parametrize("method", ["set_order", "_set", "_run", "stage"])
def test_onboarding_again_after_a_failure_keeps_the_order(spark, store, monkeypatch, method):  # noqa: F811
    store.create_registry()
    original = getattr(Store, method)

    def dies(self, *args, **kwargs):
        if method in ("set_order", "_set", "stage") or "RENAME" in args[0]:
            raise Crash
        return original(self, *args, **kwargs)

    monkeypatch.setattr(Store, method, dies)
    with pytest.raises(Crash):
        onboard(store, ordered_pack(), things(spark), DAY)
    monkeypatch.undo()
    assert not store.exists("things") and not store.versions("things")
    onboard(store, ordered_pack(), things(spark), DAY)
    assert store.order("things") == ["k"] and store.read(RULE_MAPPINGS).count() == 3


def test_a_table_without_an_order_gets_the_packs(spark, store):  # noqa: F811
    onboard(store, small_pack(), things(spark), DAY)
    assert store.order("things") == []
    onboard(store, ordered_pack(), things(spark), DAY)
    assert store.order("things") == ["k"]


# updates and locks ------------------------------------------------------------


def test_registered_rows_take_on_a_changed_pack(spark, store):  # noqa: F811
    pack = small_pack()
    onboard(store, pack, things(spark), DAY)
    before = {r.rule_mapping_id: r.asDict() for r in store.read(RULE_MAPPINGS).collect()}
    rules = tuple(dataclasses.replace(r, threshold_pct=r.threshold_pct - 7) if i == 0 else r for i, r in enumerate(pack.rules))
    changed = dataclasses.replace(pack, rules=(*rules, PackRule(77, "RULE_11_NUMERIC_POSITIVE", "v", "new", 50.0, None)), owner_dept="Others")
    onboard(store, changed, things(spark), dt.date(2030, 1, 1))
    kept = {r.rule_mapping_id: r.asDict() for r in store.read(RULE_MAPPINGS).collect()}
    assert {k: kept[k] for k in before} == before and 77 in kept  # insert-only unless asked
    onboard(store, changed, things(spark), dt.date(2031, 1, 1), update=True)
    after = {r.rule_mapping_id: r.asDict() for r in store.read(RULE_MAPPINGS).collect()}
    first = pack.rules[0].rule_mapping_id
    assert after[first] == before[first] | {"threshold_pct": before[first]["threshold_pct"] - 7, "owner_dept": "Others"}
    assert {r["owner_dept"] for r in after.values()} == {"Others"} and after[77] == kept[77] | {"owner_dept": "Others"}
    assert store.read(VALIDATION_REQUEST).select("owner_dept", "created_date").collect() == [("Others", DAY)]
    shown = store.version(RULE_MAPPINGS)
    onboard(store, changed, things(spark), DAY, update=True)  # nothing differs: nothing is written
    assert store.version(RULE_MAPPINGS) == shown
    register_mappings(store, small_pack(rules=()), update=True)
    assert store.read(RULE_MAPPINGS).count() == 4


def test_two_sessions_register_at_once(spark, store, monkeypatch):  # noqa: F811
    monkeypatch.setattr(store_module, "LOCK_POLL", 0.05)
    store.create_registry()
    failures = []

    def register(n):
        try:
            own = Store(spark.newSession(), store.schema)
            rule = (f"RULE_7{n}_OWN", "text", "VALIDITY", "detail", "{a} > 0", "NUMERIC", "p", "s")
            register_rules(own, [("RULE_SHARED", *rule[1:]), rule], DAY)
        except Exception as error:  # noqa: BLE001
            failures.append(error)

    threads = [threading.Thread(target=register, args=(n,)) for n in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failures
    rows = store.read(RULES_GENERIC).collect()
    assert sorted(r.generic_rule_id for r in rows) == [1, 2, 3, 4, 5]
    assert len({r.generic_rule_desc_short for r in rows}) == 5 and not [t for t in store.tables() if "lock" in t]


def test_a_lock_left_by_a_crash_is_broken(spark, store, monkeypatch):  # noqa: F811
    monkeypatch.setattr(store_module, "LOCK_POLL", 0.01)
    spark.sql(f"CREATE TABLE {store.name('t__lock')} (n INT) USING parquet TBLPROPERTIES ('plumbline.held_since' = '1')")
    with store.exclusive("t"):
        assert store.exists("t__lock")
    assert not store.exists("t__lock")


# the log ----------------------------------------------------------------------


def test_reports_of_the_latest_run_open_its_days_only(spark, store):  # noqa: F811
    onboard(store, small_pack(), things(spark), DAY)
    other = dataclasses.replace(small_pack(), entity="others", rules=tuple(dataclasses.replace(r, rule_mapping_id=r.rule_mapping_id + 900) for r in small_pack().rules))
    onboard(store, other, things(spark), DAY)
    run_entity(store, "others", "2024-01-01", dt.datetime(2024, 1, 1, 12))
    for day in range(1, 9):
        run_entity(store, "things", "2024-01-01", dt.datetime(2024, 2, day, 23, 30))
    assert store.log_days() == ["2024-01-01", *[f"2024-02-0{d}" for d in range(1, 9)]]
    mappings, log = store.read(RULE_MAPPINGS), store.read(RESULTS)
    assert "dq_run_date" not in log.columns

    def days(frame):
        return {f.split("dq_run_date=")[1][:10] for f in frame.inputFiles()}

    newest = recent_log(store, reports.of_entity(mappings, "things"))
    assert days(newest) == {"2024-02-08"}
    assert "PartitionFilters: [isnotnull(dq_run_date" in newest._jdf.queryExecution().executedPlan().toString()
    older = recent_log(store, reports.of_entity(mappings, "others"))
    assert days(older) == {"2024-01-01", "2024-02-01"}
    for entity in ("things", "others", None):
        got = {k: values(v) for k, v in entity_reports(store, entity, latest=True).items()}
        whole = {
            "overall": reports.overall(log, mappings if entity else None, entity, True),
            "breach_register": reports.breach_register(log, mappings, store.read(RULES_GENERIC), entity, True),
        }
        assert {k: got[k] for k in whole} == {k: values(v) for k, v in whole.items()}
    with pytest.raises(ValueError, match="already in the audit log"):
        check_new_run(store, dt.datetime(2024, 2, 3, 23, 30), [r.dq_rule_no for r in mappings.collect()])


def test_days_follow_instants_in_any_zone(spark, store):  # noqa: F811
    """A run in the night belongs to the same day for every session."""
    store.create_registry()
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for i, name in enumerate(["Asia/Tokyo", "America/New_York", "UTC"]):
            spark.conf.set("spark.sql.session.timeZone", name)
            append_run(store, dt.datetime(2024, 5, 1, 23, 30 + i, tzinfo=dt.timezone.utc), [("r", 1, 1)])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert store.log_days() == ["2024-05-01"]
    assert [r.dq_run_id for r in recent_log(store).orderBy("dq_execution_timestamp").collect()] == [1, 2, 3]
