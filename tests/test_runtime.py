from pyspark.sql import functions as F

from pressglean import runtime as R


class Context:
    def __init__(self, master):
        self.master, self.applicationId = master, f"app-{master}"

    def getCheckpointDir(self):
        return None


class Session:
    def __init__(self, master, where=None):
        self.sparkContext, self.conf = Context(master), {"spark.checkpoint.dir": where} if where else {}


def test_shared_folder():
    assert R.shared_dir(Session("yarn", "hdfs:///x/")) == "hdfs:///x"
    local = Session("local[2]")
    assert R.shared_dir(local) == R.shared_dir(local)
    try:
        R.shared_dir(Session("yarn"))
    except RuntimeError:
        return
    raise AssertionError


def test_written_and_small(spark):
    df = spark.range(10)
    assert R.written(df, "t").count() == 10
    big, small = R.small_side(df, "t", 5), R.small_side(df, "t", 50)
    plan = lambda other: spark.range(20).join(other, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(small) and "broadcast" not in plan(big)
    assert small.agg(F.sum("id")).first()[0] == 45


def test_forgotten(spark):
    a, b = R.written(spark.range(3), "t"), R.written(spark.range(4), "t")
    assert R.forgotten(spark, a, None) == 1 and b.count() == 4
    assert R.forgotten(spark, spark.range(1)) == 0
    assert R.forgotten(spark) >= 1 and R.forgotten(spark) == 0
