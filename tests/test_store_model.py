"""Model check of the table store: random upserts, deletes and vacuums equal a dict."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidesync.operators.load import upsert
from tidesync.plans.commit import BUCKET, SHARD, TableStore, unit_key

op = st.one_of(
    st.tuples(st.just("upsert"), st.lists(st.tuples(st.integers(0, 40), st.integers(0, 9)), min_size=1, max_size=12)),
    st.tuples(st.just("delete"), st.lists(st.integers(0, 40), min_size=1, max_size=6)),
    st.tuples(st.just("vacuum"), st.integers(1, 2)),
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ops=st.lists(op, min_size=1, max_size=4))
def test_store_equals_dict_model(spark, scratch, ops):
    store = TableStore(spark, scratch("model"))
    model: dict[int, int] = {}
    schema = "k int, v int"

    def units_of(keys):
        return sorted({unit_key(k // 8 + 1, k % 3) for k in keys})

    def framed(rows):
        return (spark.createDataFrame(rows, schema)
                .withColumns({SHARD: (F.col("k") / 8).cast("long") + 1, BUCKET: (F.col("k") % 3).cast("long")}))

    for kind, arg in ops:
        if kind == "upsert":
            last = {}
            for k, v in arg:
                last[k] = v                      # later rows of a batch win
            rows = sorted(last.items())
            units = units_of(last)
            old = store.read(units=units, keep_unit=True) if store.version() else None
            new = framed(rows) if old is None else upsert(old, framed(rows), [SHARD, BUCKET, "k"], dedupe=False)
            store.commit(new, touched=units)
            model.update(last)
        elif kind == "delete" and store.version():
            gone = set(arg)
            units = units_of(gone)
            kept = store.read(units=units, keep_unit=True).filter(~F.col("k").isin(list(gone)))
            store.commit(kept, touched=units)
            for k in gone:
                model.pop(k, None)
        elif kind == "vacuum":
            store.vacuum(keep=arg)
        if store.version():
            got = {r["k"]: r["v"] for r in store.read().collect()}
            assert got == model
