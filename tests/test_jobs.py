import json
import os

from shopmetrics import jobs
from shopmetrics.plans import catalog as C
from shopmetrics.sources import ingest as IN
from shopmetrics.sources import tables as TB

SF = "/root/testdata/sf0.001"


def test_ingest_refresh_train_score_lookup(spark, workdir, capsys):
    root = f"{workdir}/lake"
    msgs = f"{workdir}/msgs"
    IN.encode_messages(C.q_bronze_products(spark, SF)).repartition(2).write.text(msgs)
    jobs.cmd_ingest(spark, jobs.parser().parse_args(["ingest", "--root", root, "--messages", msgs,
                                                      "--max-per-trigger", "1"]))
    assert TB.read_table(spark, f"{root}/silver").count() == 200
    jobs.cmd_refresh(spark, jobs.parser().parse_args(["refresh", "--root", root]))
    model = f"{workdir}/model"
    jobs.cmd_train(spark, jobs.parser().parse_args(["train", "--root", root, "--model", model, "--small",
                                                     "--keys", "Category", "Year"]))
    req_dir = (workdir.replace("file:", "")) + "/req"
    os.makedirs(req_dir, exist_ok=True)
    with open(f"{req_dir}/r.json", "w") as f:
        f.write(json.dumps({"request_id": 1, "price": 99.99, "discount_percentage": 15, "rating": 4.5,
                            "num_reviews": 100, "category": "PROMO"}) + "\n")
        f.write(json.dumps({"request_id": 2, "price": -1, "discount_percentage": 15, "rating": 4.5,
                            "num_reviews": 100, "category": "PROMO"}) + "\n")
    out = f"{workdir}/scored"
    jobs.cmd_score(spark, jobs.parser().parse_args(["score", "--model", model, "--requests", req_dir, "--out", out]))
    pred = spark.read.parquet(f"{out}/predictions").collect()
    assert [r.request_id for r in pred] == [1] and pred[0].predicted_sales is not None
    assert [r.request_id for r in spark.read.parquet(f"{out}/rejected").collect()] == [2]
    jobs.cmd_lookup(spark, jobs.parser().parse_args(["lookup", "--root", root, "--table", "revenue_per_category",
                                                      "--category", "PROMO", "--out", f"{workdir}/lk"]))
    assert [r.Category for r in spark.read.json(f"{workdir}/lk").collect()] == ["PROMO"]
    jobs.cmd_lookup(spark, jobs.parser().parse_args(["lookup", "--root", root, "--table", "categories",
                                                      "--out", f"{workdir}/cats"]))
    cats = sorted(r.Category for r in spark.read.json(f"{workdir}/cats").collect())
    assert cats == sorted({"ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"})



def test_coordinator_retrains_only_on_change_or_interval(spark, workdir):
    import time as _t
    root = f"{workdir}/lake"
    msgs = f"{workdir}/msgs"
    IN.encode_messages(C.q_bronze_products(spark, SF)).write.text(msgs)
    jobs.cmd_ingest(spark, jobs.parser().parse_args(["ingest", "--root", root, "--messages", msgs, "--refresh", "full"]))
    args = ["coordinate", "--root", root, "--model", f"{workdir}/model", "--state", f"{workdir}/state",
            "--small", "--min-interval", "3600", "--keys", "Category", "Year"]
    assert jobs.cmd_coordinate(spark, jobs.parser().parse_args(args)) is True    # first run trains
    assert jobs.cmd_coordinate(spark, jobs.parser().parse_args(args)) is False   # nothing changed, too soon
    _t.sleep(1.1)
    jobs.cmd_refresh(spark, jobs.parser().parse_args(["refresh", "--root", root]))  # gold files rewritten
    assert jobs.cmd_coordinate(spark, jobs.parser().parse_args(args)) is True



def test_publish_then_ingest(spark, workdir):
    import os as _os
    d = workdir.replace("file:", "") + "/raw"
    _os.makedirs(d, exist_ok=True)
    with open(f"{d}/a.csv", "w") as f:
        f.write("ProductID,ProductName,Category,Price,Rating,NumReviews,StockQuantity,Sales,Discount,DateAdded,City,StockStatus\n")
        f.write("1,Lamp,home,19.99,4.5,120,30,0.5,10,2024-03-01,Oslo!,TRUE\n2,Cup,home,x,4,1,1,1,0,2024-04-02,Rome,TRUE\n")
    msgs = f"{workdir}/msgs"
    jobs.cmd_publish(spark, jobs.parser().parse_args(["publish", "--csv", d, "--messages", msgs]))
    assert [r.ProductID for r in IN.decode_messages(spark.read.text(msgs)).collect()] == [1]
    assert [r.ProductID for r in spark.read.json(f"{msgs}_rejected").collect()] == [2]
    root = f"{workdir}/lake"
    jobs.cmd_ingest(spark, jobs.parser().parse_args(["ingest", "--root", root, "--messages", msgs]))
    g = TB.read_gold(spark, f"{root}/gold", "revenue_per_category").collect()
    assert [(r.Category, r.ProductCount) for r in g] == [("HOME", 1)]
