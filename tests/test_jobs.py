"""Jobs from files to files."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from tickloom.config import FeatureConfig
from tickloom.operators.forecasts import forecast_frame
from tickloom.operators.scoring import last_value_scorer
from tickloom.plans.forecasting import stored_requests
from tickloom.plans.jobs import feature_job, manifest_job, score_job
from tickloom.sources.files import read_split

SCORED = "request_id string, quantiles map<string,array<double>>"


def write_bars(folder, instrument, weeks=8, minutes=90):
    lines = ["Gmt time,Open,High,Low,Close,Volume"]
    for week in range(weeks):
        for i in range(minutes):
            at = datetime(2019, 1, 7) + timedelta(weeks=week, minutes=i)
            price = 1 + week / 4 + i / 64
            lines.append(f"{at:%d.%m.%Y %H:%M:%S}.000,{price},{price},{price},{price + 1},{i}")
    (folder / f"{instrument}_1m.csv").write_text("\n".join(lines) + "\n")


def test_bars_to_features_to_predictions(spark, tmp_path):
    bars = tmp_path / "bars"
    bars.mkdir()
    for name in ("audusd", "eurusd", "usdjpy", "unlisted"):
        write_bars(bars, name)
    cfg = FeatureConfig(test_weeks=2, holdout_weeks=2, n_tests=6)
    out = str(tmp_path / "features")
    for _ in range(2):
        feature_job(spark, str(bars / "*_1m.csv"), out, cfg)
    sizes = {s: read_split(spark, out, s).count() for s in ("train", "test", "holdout")}
    assert sizes == {"train": 3 * 4 * 4, "test": 3 * 4 * 2 * 6, "holdout": 3 * 4 * 1 * 6}
    train = read_split(spark, out, "train").where("cat = array(1, 2)").orderBy("start").first()
    assert train["start"] == "2019-01-07 00:00:00" and len(train["target"]) == 90
    assert train["target"][:2] == [0.0, 10.0 / 64]
    assert {len(r["target"]) for r in read_split(spark, out, "test").collect()} == {60}

    holdout, predicted = f"{out}/split=holdout", str(tmp_path / "predictions")
    score_job(spark, holdout, predicted, last_value_scorer(30, ("0.5",)), SCORED, 30)
    requests = stored_requests(spark, holdout, 30)
    assert requests.select("request_id").distinct().count() == requests.count() == 72
    predictions = spark.read.schema(SCORED).json(predicted)
    frame = forecast_frame(requests, predictions)
    assert frame.where("series = 'actual'").count() == 72 * 60
    ahead = frame.where("series = '0.5 quantile'")
    assert ahead.count() == 72 * 30 and ahead.agg({"position": "min"}).first()[0] == 30
    assert len(stored_requests(spark, holdout, 30, limit=5).collect()) == 5


def test_manifest_to_two_manifests(spark, tmp_path):
    source = tmp_path / "output.manifest"
    source.write_text("".join(json.dumps({"source-ref": f"x/images/{i}", "k": i}) + "\n" for i in range(20)))
    counts = manifest_job(spark, str(source), "root", str(tmp_path / "out"))
    assert {r["split"]: r["n"] for r in counts.collect()} == {"train": 16, "validation": 4}
