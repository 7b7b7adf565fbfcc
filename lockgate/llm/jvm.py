"""Java beside this module: compiled by Spark's own compiler, on executors as a jar, once a session."""

from __future__ import annotations

import zipfile
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.classic.column import _to_seq

from lockgate.sources.storage import local_folder

#: Class loaders by application and source.
_LOADERS: dict = {}


def _compiled(spark: SparkSession, name: str):
    """A class loader with the classes of ``name``.java; the application's executors get them too."""
    sc, jvm = spark.sparkContext, spark._jvm
    compiler = jvm.org.codehaus.janino.SimpleCompiler()
    compiler.setParentClassLoader(jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader())
    compiler.cook(files(__package__).joinpath(f"{name}.java").read_text())
    jar = f"{local_folder()}/{name}-{sc.applicationId}.jar"
    with zipfile.ZipFile(jar, "w") as out:
        for made, code in compiler.getBytecodes().items():
            out.writestr(made.replace(".", "/") + ".class", bytes(code))
    sc._jsc.addJar(jar)
    return compiler.getClassLoader()


def made(spark: SparkSession, name: str, *args):
    """A new object of a class of package ``lockgate``, by its only constructor."""
    sc = spark.sparkContext
    key = sc.applicationId, name.partition("$")[0]
    if key not in _LOADERS:
        _LOADERS[key] = _compiled(spark, key[1])
    given = sc._gateway.new_array(spark._jvm.java.lang.Object, len(args))
    for i, arg in enumerate(args):
        given[i] = arg
    return _LOADERS[key].loadClass(f"lockgate.{name}").getDeclaredConstructors()[0].newInstance(given)


def shared(spark: SparkSession, value: bytes):
    """A broadcast of bytes that Java reads."""
    return spark.sparkContext._jsc.broadcast(value)


def mapped(df: DataFrame, function, schema: str) -> DataFrame:
    """The rows that ``function`` makes of each partition's."""
    jvm = df.sparkSession._jvm
    kind = jvm.org.apache.spark.sql.types.StructType.fromDDL(schema)
    return DataFrame(df._jdf.mapPartitions(function, jvm.org.apache.spark.sql.Encoders.row(kind)), df.sparkSession)


def called(spark: SparkSession, function, kind: str, of: Column) -> Column:
    """What ``function`` makes of a column, in each row."""
    jvm = spark._jvm
    own = jvm.org.apache.spark.sql.functions.udf(function, jvm.org.apache.spark.sql.types.DataType.fromDDL(kind))
    return Column(own.apply(_to_seq(spark.sparkContext, [of._jc])))
