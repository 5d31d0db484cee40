"""The monthly close end to end on the smallest driver tables (through the role adapter)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cellmart import schemas
from cellmart.operators.quality import GateError
from cellmart.plans import close, roles
from cellmart.plans.close import CloseTables, monthly_close
from cellmart.sinks import writers

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2001, 8, 15)
TS = dt.datetime(2001, 8, 15, 6)


def _setup(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    t = CloseTables(landing=p("landing"), usage=p("usage"), daily_base=p("daily_base"),
                    legacy_base=p("legacy_base"), base=p("base"), devices=p("devices"), products=p("products"),
                    products2=p("products2"), cells=p("cells"), device_history=p("history"), mart=p("mart"))
    u = roles.usage(spark, SF)
    cols = ["month_id"] + schemas.USAGE_COLUMNS
    full = u.select(*[F.col(c) if c in u.columns else F.lit(None).cast(schemas.MONTHLY_STAGING[c].dataType).alias(c)
                      for c in cols])
    month = full.filter(F.col("month_id") == 200107)
    # three landed files for the month (plus the manifest)
    month.repartition(3).write.option("sep", "|").option("header", True).option("compression", "gzip") \
        .csv(t.landing + "/EE_USAGE_200107")
    # Landed files carry the month in their names.
    for f in list((tmp_path / "landing" / "EE_USAGE_200107").glob("part-*")):
        f.rename(f.with_name("usage_200107_" + f.name))
    n = month.count()
    spark.createDataFrame([("HASH",), (str(n),)], "value string").coalesce(1).write.text(t.landing + "/EE_200107_HASH")
    for name, df in (("daily_base", roles.daily_base(spark, SF)), ("legacy_base", roles.legacy_base(spark, SF)),
                     ("devices", roles.devices(spark, SF)), ("products", roles.products(spark, SF)),
                     ("products2", roles.products2(spark, SF)), ("cells", roles.cells(spark, SF))):
        writers.refresh(df, getattr(t, name))
    return t, n


def test_monthly_close(spark, tmp_path):
    t, n = _setup(spark, tmp_path)
    sizes = []
    for _ in range(2):   # a close that runs again changes nothing
        out = monthly_close(spark, t, AS_OF, TS, min_files=2, data_glob="EE_USAGE_200107/*.csv.gz",
                            manifest_glob="EE_200107_HASH/*.txt")
        assert out["rows_loaded"] == out["rows_expected"] == n
        assert out["base_rows"] > 0 and out["mart_rows"] > 0 and out["period_start"] == dt.date(2001, 7, 1)
        assert "NEW_ACTIVE90D_PAYG" in spark.read.parquet(t.mart).columns
        sizes.append([spark.read.parquet(x).count() for x in (t.usage, t.mart, t.base, t.device_history)])
    assert sizes[0] == sizes[1] and all(sizes[0])


def test_monthly_close_gate(spark, tmp_path):
    t, _ = _setup(spark, tmp_path)
    with pytest.raises(GateError):
        monthly_close(spark, t, AS_OF, TS, min_files=102, data_glob="EE_USAGE_200107/*.csv.gz",
                      manifest_glob="EE_200107_HASH/*.txt")


def test_a_close_that_breaks_goes_on_at_the_step_that_broke(spark, tmp_path, monkeypatch):
    t, n = _setup(spark, tmp_path)
    calls = []

    def run(broken=None):
        with monkeypatch.context() as m:
            for step, owner, name in (("load", close.loads, "monthly_load_with_checks"), ("base", close.subscribers, "subscriber_base"),
                                      ("history", close.devices, "best_device_history"), ("mart", close.usage, "publish_and_flag")):
                plain = getattr(owner, name)

                def work(*args, step=step, plain=plain, **kwargs):
                    calls.append(step)
                    if step == broken:
                        raise RuntimeError(step)
                    return plain(*args, **kwargs)

                m.setattr(owner, name, work)
            return monthly_close(spark, t, AS_OF, TS, min_files=3, data_glob="EE_USAGE_200107/*.csv.gz",
                                 manifest_glob="EE_200107_HASH/*.txt", journal=str(tmp_path / "journal"))

    for step in close.STEPS:
        with pytest.raises(RuntimeError, match=step):
            run(step)
    out = run()
    # Each step ran once to its end, and was tried once before.
    assert calls == [s for step in close.STEPS for s in (step, step)]
    assert out["rows_loaded"] == out["rows_expected"] == n and out["base_rows"] > 0 and out["mart_rows"] > 0
    before = len(calls)
    assert run() == out and len(calls) == before
