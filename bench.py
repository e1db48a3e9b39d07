"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from oddspend.operators import features as B, insights as I, profile as V  # noqa: E402
from oddspend.operators.models.autoencoder import Autoencoder  # noqa: E402
from oddspend.operators.models.iforest import IsolationForest  # noqa: E402
from oddspend.plans import queries as Q  # noqa: E402
from oddspend.session import local_session, materialize  # noqa: E402
from oddspend.sources import views  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    spark = local_session(CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    d, seconds, rates = FOLDER, {}, {}
    registry = Q.queries()

    def clock(name, run, rows=None):
        start = time.perf_counter()
        out = run()
        seconds[name] = round(time.perf_counter() - start, 3)
        if rows:
            rates[name] = round(rows / seconds[name])
        return out

    noop(B.customer_history(views.txn_events(spark, d)))  # start-up of the engine is not a query
    events = views.table(spark, d, "events").count()

    clock("suspicious_now", lambda: noop(registry["suspicious_now"](spark, d)), events)
    clock("profile_report", lambda: noop(V.report(views.raw_card(spark, d))), events)
    clock("clean_full", lambda: noop(registry["clean_full"](spark, d)), events)
    clock("features_full", lambda: noop(registry["features_full"](spark, d)), events)
    clock("features_orders", lambda: noop(registry["features_orders"](spark, d)))
    clock("encode_rows", lambda: Q.encoded(spark, d))  # clean, features, split, encoder, encoding
    rows = Q.encoded(spark, d)
    train, n = rows.filter("split = 'train'"), rows.count()
    forest = clock("isolation_forest_fit", lambda: IsolationForest().fit(train))
    clock("isolation_forest_predict", lambda: noop(forest.predict(rows)), n)
    net = clock("autoencoder_fit", lambda: Autoencoder().fit(train))
    clock("autoencoder_predict", lambda: noop(net.predict(rows)), n)
    # the shipped prediction timings are for 252,000 rows: repeat ours up to that
    times = -(-252_000 // n)
    many = materialize(rows.select("row_id", "features").withColumn(
        "_k", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("_k"), "many", parallel=True)
    clock("isolation_forest_predict_252k", lambda: noop(forest.predict(many)), n * times)
    clock("autoencoder_predict_252k", lambda: noop(net.predict(many)), n * times)
    clock("evaluate_models", lambda: noop(registry["evaluate_models"](spark, d)))
    clock("explain_topn", lambda: noop(registry["explain_topn"](spark, d)))
    clock("correlation_matrix", lambda: noop(registry["correlation_matrix"](spark, d)))
    lines = views.txn_lines(spark, d)
    clock("amount_box_by_category", lambda: noop(I.box_stats(lines, "l_returnflag")))
    clock("top_customer_spend", lambda: noop(registry["top_customer_spend"](spark, d)))
    clock("amount_histogram", lambda: noop(registry["amount_histogram"](spark, d)))
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "rows_per_sec": rates, "sf": os.path.basename(d.rstrip("/")), "cpus": CPUS}))
    spark.stop()


if __name__ == "__main__":
    main()
