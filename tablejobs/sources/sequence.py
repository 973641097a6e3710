"""SequenceFile storage without a Hive catalog: the lines of a text table as the values of the file.

Keys and values pass between Hadoop's types and Spark's inside the JVM, by the converters Spark has for pairs; no Python
worker takes part. In a session with a Hive catalog ``scan_table`` reads such tables too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.descriptor import DEFAULT_DELIMITER, LINE, TableDescriptor
from tablejobs.sinks.text import join_fields
from tablejobs.sources.text import split_lines


def _class(spark: SparkSession, name: str):
    return spark._jvm.java.lang.Class.forName(name)


def _converted(spark: SparkSession, pairs, converter):
    """A Java RDD of pairs whose keys and values a converter has changed."""
    changed = spark._jvm.org.apache.spark.api.python.PythonHadoopUtil.convertRDD(pairs, converter, converter)
    tag = spark._jvm.scala.reflect.ClassTag.AnyRef()
    return spark._jvm.org.apache.spark.api.java.JavaPairRDD.fromRDD(changed, tag, tag)


def scan_sequence_table(spark: SparkSession, table: TableDescriptor, path: str, bad_rows: str = "null") -> DataFrame:
    """The rows of a table from the values of SequenceFiles; keys are not read. ``bad_rows``: see ``split_lines``."""
    jvm, context = spark._jvm, spark._jsc
    writable = _class(spark, "org.apache.hadoop.io.Writable")
    settings = context.broadcast(jvm.org.apache.spark.util.SerializableConfiguration(context.hadoopConfiguration()))
    # Hadoop uses one object for all values of a split; the converter takes the text out of each.
    plain = jvm.org.apache.spark.api.python.WritableToJavaConverter(settings)
    texts = _converted(spark, context.sequenceFile(path, writable, writable).rdd(), plain).values()
    lines = spark._jsparkSession.createDataset(texts.rdd(), jvm.org.apache.spark.sql.Encoders.STRING())
    return split_lines(DataFrame(lines.toDF(), spark).toDF(LINE), table, bad_rows=bad_rows)


def write_sequence_table(
    df: DataFrame, table: TableDescriptor, path: str, codec: str | None = None
) -> None:
    """Write rows as the values of SequenceFiles without keys. ``codec`` names a compression class."""
    spark = df.sparkSession
    jvm = spark._jvm
    text = jvm.org.apache.spark.sql.Encoders.STRING()
    lines = join_fields(df, table.delimiter or DEFAULT_DELIMITER).select(F.lit(None).cast("string").alias("key"), LINE)
    pairs = getattr(lines._jdf, "as")(jvm.org.apache.spark.sql.Encoders.tuple(text, text)).rdd()
    written = _converted(spark, pairs, jvm.org.apache.spark.api.python.JavaToWritableConverter())
    job = jvm.org.apache.hadoop.mapred.JobConf(spark._jsc.hadoopConfiguration())
    output = jvm.org.apache.hadoop.mapred.FileOutputFormat
    output.setCompressOutput(job, codec is not None)
    if codec is not None:
        output.setOutputCompressorClass(job, _class(spark, codec))
    kinds = ("org.apache.hadoop.io.NullWritable", "org.apache.hadoop.io.Text", "org.apache.hadoop.mapred.SequenceFileOutputFormat")
    written.saveAsHadoopFile(path, *[_class(spark, name) for name in kinds], job)
