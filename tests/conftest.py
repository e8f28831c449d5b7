import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from candela.session import get_spark
    s = get_spark("local[4]", app="candela-tests", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="candela-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def small_blocks(spark):
    """Tiny blocks so every multi-block path (halo rows, carries, sub-blocks) runs on small data."""
    spark.conf.set("spark.candela.blockRows", "16")
    spark.conf.set("spark.candela.bucketSeconds", str(3 * 86400))
    yield spark
    spark.conf.unset("spark.candela.blockRows")
    spark.conf.unset("spark.candela.bucketSeconds")


SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
