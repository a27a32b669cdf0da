"""The column functions and row rules hold no state, so they run on a stream as they do on a table."""

from pyspark.sql import functions as F

from rosterlift.functions.contact import email_norm, phone_norm
from rosterlift.quality import predicates as P


def test_rules_on_a_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, " A@B.com ", "+44 1"), (2, "bad", "x")], "id int, email string, phone string")
    df.write.parquet(str(tmp_path / "in"))
    def clean(rows):
        email = email_norm("email")
        return rows.select("id", email.alias("email"), phone_norm("phone").alias("phone"), P.not_basic_email(email).alias("bad"))
    stream = clean(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    query = (stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    query.awaitTermination(60)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.orderBy("id").collect() == clean(df).orderBy("id").collect()
    assert out.where(F.col("bad")).count() == 1
