import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="contentrisk-test-ckpt-")
    s = (SparkSession.builder.master("local[4]")
         .appName("contentrisk-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture
def mock_images_enriched(spark):
    """The three constant image rows the reference's preparation scripts create."""
    import datetime as dt
    ts = dt.datetime(2024, 1, 30, 12, 0, 0)
    rows = [("img_001", "unsplash", "/path/to/img1.jpg", "", False, False, "benign", [], ts, 0),
            ("img_002", "picsum", "/path/to/img2.jpg", "sample text", True, False, "benign", [], ts, 10),
            ("img_003", "placeholder", "/path/to/img3.jpg", "", False, False, "benign", [], ts, 0)]
    return spark.createDataFrame(rows, "id string, source string, filepath string, extracted_text string, "
                                       "ocr_success boolean, is_threat boolean, threat_severity string, "
                                       "threat_categories array<string>, enrichment_timestamp timestamp, "
                                       "text_length int")
