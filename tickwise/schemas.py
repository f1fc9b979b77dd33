"""Fixed table schemas of the tick pipeline.

Time is text (``yyyy-MM-dd HH:mm:ss[.S]``) everywhere, as in the source
system; lexicographic order of that text is the time order.  Column names are
lower case (the tables were case-insensitive Hive/SQL tables).
"""

from pyspark.sql import types as T

# raw tick as parsed by the batch ingest (volume is an int there)
TICK = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestampvalue", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.IntegerType()),
])

# raw tick as parsed by the streaming path (volume is a double there)
STREAM_TICK = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestampvalue", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

# stock_transformation_temp: output of the batch ratio query
TRANSFORMED = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestampvalue", T.StringType()),
    T.StructField("avgprice", T.DoubleType()),
    T.StructField("pricechange", T.DoubleType()),
    T.StructField("avgvol", T.DoubleType()),
    T.StructField("volumechange", T.DoubleType()),
    T.StructField("ratio", T.DoubleType()),
])

# stock_transformation: historical ratio per (symbol, time of day)
HISTORY = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestampvalue", T.StringType()),
    T.StructField("avgprice", T.DoubleType()),
    T.StructField("pricechange", T.DoubleType()),
    T.StructField("avgvolume", T.DoubleType()),
    T.StructField("volumechange", T.DoubleType()),
    T.StructField("ratio", T.DoubleType()),
    T.StructField("histratio", T.DoubleType()),
])

# stock: one real-time metrics row per tick
STOCK = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestampvalue", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("priceavg", T.DoubleType()),
    T.StructField("pricechange", T.DoubleType()),
    T.StructField("volumeavg", T.DoubleType()),
    T.StructField("volumechange", T.DoubleType()),
    T.StructField("ratio", T.DoubleType()),
    T.StructField("insertflag", T.TimestampType()),
])

# stock_alert
ALERT = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestampvalue", T.StringType()),
    T.StructField("histratio", T.DoubleType()),
    T.StructField("currentratio", T.DoubleType()),
    T.StructField("ratiodeviation", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
])

PRIMARY_KEY = ("symbol", "timestampvalue")
