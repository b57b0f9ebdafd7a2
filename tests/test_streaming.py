import json
import os

from rentalytics.sources.config import config_frame
from rentalytics.streaming.refresh import start_refresh
from tests.test_pipeline import SETTINGS


def test_manifest_arrival_publishes_city(spark, tmp_path, fixtures):
    landing, out = tmp_path / "landing", tmp_path / "star"
    landing.mkdir()
    (landing / "drop1.json").write_text(json.dumps({"city": "brisk", "raw_base": fixtures}) + "\n")
    q = start_refresh(spark, str(landing), str(out), checkpoint=str(tmp_path / "ckpt"),
                      config=config_frame(spark, SETTINGS), strict=False)
    q.awaitTermination(300)
    got = spark.read.parquet(str(out / "fact_listings")).groupBy("city").count().collect()
    assert [tuple(r) for r in got] == [("brisk", 3)]
    assert os.path.isdir(out / "pipeline_metadata")
