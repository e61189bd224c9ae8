"""Event log, catalogue, arrival records, demographics and airports derived from the shared test tables.

Each has a Spark form, laid out as the library's declared source schema, and the equal SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright import schemas
from tablewright.functions import epoch_millis
from tablewright.registry.base import table

DAY_MS = 86_400_000

EVENT_SQL = f"""
    SELECT p.p_brand AS artist, 'Logged In' AS auth, c.c_mktsegment AS firstName,
        CASE WHEN c.c_nationkey < 12 THEN 'F' ELSE 'M' END AS gender, l.l_linenumber::BIGINT AS itemInSession,
        c.c_name AS lastName,
        CASE WHEN l.l_linenumber = 1 THEN p.p_retailprice + 0.5 ELSE p.p_retailprice END AS length,
        CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'paid' ELSE 'free' END AS level,
        'N' || c.c_nationkey AS location, 'PUT' AS method,
        CASE WHEN l.l_returnflag = 'R' THEN 'Home' ELSE 'NextSong' END AS page, c.c_acctbal AS registration,
        l.l_orderkey AS sessionId,
        CASE WHEN l.l_linenumber = 2 THEN p.p_name ELSE p.p_name || ' ' || p.p_type END AS song,
        200::BIGINT AS status,
        (epoch_ms(l.l_shipdate) + (l.l_orderkey * 7919 + l.l_suppkey * 31) % {DAY_MS})::BIGINT AS ts,
        l.l_linestatus AS userAgent,
        CASE WHEN c.c_nationkey = 24 THEN '' ELSE c.c_custkey::VARCHAR END AS userId
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN part p ON l.l_partkey = p.p_partkey
"""

CATALOGUE_SQL = """
    SELECT 1 AS num_songs, 'A' || substr(p_brand, 7) AS artist_id,
        CASE WHEN p_size <= 25 THEN p_size::DOUBLE END AS artist_latitude,
        CASE WHEN p_size <= 25 THEN p_size * 2.0::DOUBLE END AS artist_longitude,
        p_type AS artist_location, p_brand AS artist_name, 'S' || (p_partkey // 2) AS song_id,
        p_name || ' ' || p_type AS title, p_retailprice AS duration,
        CASE WHEN p_size < 10 THEN 0 ELSE 1970 + p_size END AS year
    FROM part
"""

ARRIVALS_SQL = """
    SELECT CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN NULL ELSE l_orderkey::DOUBLE END AS cicid,
        year(l_shipdate)::DOUBLE AS i94yr, month(l_shipdate)::DOUBLE AS i94mon, l_suppkey::DOUBLE AS i94cit,
        l_suppkey::DOUBLE AS i94res, l_quantity::DOUBLE AS arrdate, l_linenumber::DOUBLE AS i94mode,
        l_tax::DOUBLE AS depdate, l_quantity::DOUBLE AS i94bir, l_linenumber::DOUBLE AS i94visa,
        2016 - l_quantity::DOUBLE AS biryear, l_linenumber::DOUBLE AS admnum, 'P' || l_suppkey AS i94port,
        'S' || (l_linenumber + 10) AS i94addr, l_returnflag AS entdepa, l_linestatus AS entdepd,
        NULL::VARCHAR AS entdepu, CASE WHEN l_returnflag = 'N' THEN 'M' END AS matflag, 'L' || l_linenumber AS airline,
        l_partkey::VARCHAR AS fltno, NULL::VARCHAR AS occup, CASE WHEN l_linestatus = 'F' THEN 'F' ELSE 'M' END AS gender,
        'V' || l_linenumber AS visapost, l_returnflag AS visatype,
        CASE WHEN l_returnflag = 'A' THEN 'D/S' ELSE strftime(l_shipdate, '%Y%m%d') END AS dtadfile,
        CASE WHEN l_returnflag = 'N' THEN NULL ELSE strftime(l_shipdate + INTERVAL 180 DAY, '%m%d%Y') END AS dtaddto
    FROM lineitem
"""

DEMOGRAPHICS_SQL = """
    SELECT CASE WHEN c_nationkey = 3 THEN NULL ELSE c_name END AS City, n_name AS State, c_acctbal / 7 AS Median_Age,
        c_custkey::INT AS Male_Pop, (c_custkey * 2)::INT AS Female_Pop, (c_custkey * 3)::INT AS Total_Pop,
        CASE WHEN c_nationkey = 5 THEN NULL ELSE c_nationkey END AS Num_Veterans, (c_nationkey + 7)::INT AS Num_Foreign_born,
        c_acctbal / 3 AS Avg_Household_Size, 'S' || n_nationkey AS State_Code, c_mktsegment AS Race, c_custkey::INT AS Count
    FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

AIRPORTS_SQL = """
    SELECT CASE WHEN s_nationkey = 4 THEN NULL ELSE 'K' || s_suppkey END AS ident, 'small_airport' AS type, s_name AS name,
        (s_nationkey * 10)::INT AS elevation_ft, NULL::VARCHAR AS continent, n_name AS iso_country, 'R' || n_regionkey AS iso_region,
        n_name AS municipality, NULL::VARCHAR AS gps_code, 'P' || s_suppkey AS iata_code, NULL::VARCHAR AS local_code,
        CASE WHEN s_nationkey = 0 THEN NULL WHEN s_nationkey = 1 THEN s_suppkey::VARCHAR
             ELSE s_suppkey || ', ' || s_nationkey END AS coordinates
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A play per line item: the part is the song, the customer the user, the order the session.

    Orders meet their customers before the line items, of which there are several an order.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    sessions = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(sessions, F.col("l_orderkey") == F.col("o_orderkey"))
    within_day = (F.col("l_orderkey") * 7919 + F.col("l_suppkey") * 31) % DAY_MS
    values = {
        "artist": F.col("p_brand"),
        "auth": F.lit("Logged In"),
        "firstName": F.col("c_mktsegment"),
        "gender": F.when(F.col("c_nationkey") < 12, "F").otherwise("M"),
        "itemInSession": F.col("l_linenumber"),
        "lastName": F.col("c_name"),
        "length": F.when(F.col("l_linenumber") == 1, F.col("p_retailprice") + 0.5).otherwise(F.col("p_retailprice")),
        "level": F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "paid").otherwise("free"),
        "location": F.concat(F.lit("N"), F.col("c_nationkey").cast("string")),
        "method": F.lit("PUT"),
        "page": F.when(F.col("l_returnflag") == "R", "Home").otherwise("NextSong"),
        "registration": F.col("c_acctbal"),
        "sessionId": F.col("l_orderkey"),
        "song": F.when(F.col("l_linenumber") == 2, F.col("p_name")).otherwise(F.concat_ws(" ", "p_name", "p_type")),
        "status": F.lit(200),
        "ts": epoch_millis("l_shipdate") + within_day,
        "userAgent": F.col("l_linestatus"),
        "userId": F.when(F.col("c_nationkey") == 24, "").otherwise(F.col("c_custkey").cast("string")),
    }
    return _as(joined, schemas.EVENT_LOG, values)


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    values = {
        "num_songs": F.lit(1),
        "artist_id": F.concat(F.lit("A"), F.substring("p_brand", 7, 10)),
        "artist_latitude": F.when(size <= 25, size),
        "artist_longitude": F.when(size <= 25, size * 2),
        "artist_location": F.col("p_type"),
        "artist_name": F.col("p_brand"),
        "song_id": F.concat(F.lit("S"), F.shiftright("p_partkey", 1).cast("string")),
        "title": F.concat_ws(" ", "p_name", "p_type"),
        "duration": F.col("p_retailprice"),
        "year": F.when(size < 10, 0).otherwise(size + 1970),
    }
    return _as(table(spark, sf_dir, "part"), schemas.CATALOGUE, values)


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("l_linenumber")
    values = {
        "cicid": F.when(~((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R")), F.col("l_orderkey")),
        "i94yr": F.year("l_shipdate"),
        "i94mon": F.month("l_shipdate"),
        "i94cit": F.col("l_suppkey"),
        "i94res": F.col("l_suppkey"),
        "arrdate": F.col("l_quantity"),
        "i94mode": number,
        "depdate": F.col("l_tax"),
        "i94bir": F.col("l_quantity"),
        "i94visa": number,
        "biryear": F.lit(2016) - F.col("l_quantity"),
        "admnum": number,
        "i94port": F.concat(F.lit("P"), F.col("l_suppkey").cast("string")),
        "i94addr": F.concat(F.lit("S"), (number + 10).cast("string")),
        "entdepa": F.col("l_returnflag"),
        "entdepd": F.col("l_linestatus"),
        "entdepu": F.lit(None),
        "matflag": F.when(F.col("l_returnflag") == "N", "M"),
        "airline": F.concat(F.lit("L"), number.cast("string")),
        "fltno": F.col("l_partkey"),
        "occup": F.lit(None),
        "gender": F.when(F.col("l_linestatus") == "F", "F").otherwise("M"),
        "visapost": F.concat(F.lit("V"), number.cast("string")),
        "visatype": F.col("l_returnflag"),
        "dtadfile": F.when(F.col("l_returnflag") == "A", "D/S").otherwise(F.date_format("l_shipdate", "yyyyMMdd")),
        "dtaddto": F.when(
            F.col("l_returnflag") != "N", F.date_format(F.date_add(F.to_date("l_shipdate"), 180), "MMddyyyy")
        ),
    }
    return _as(table(spark, sf_dir, "lineitem"), schemas.ARRIVALS, values)


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    cities = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    values = {
        "City": F.when(nation != 3, F.col("c_name")),
        "State": F.col("n_name"),
        "Median_Age": F.col("c_acctbal") / 7,
        "Male_Pop": key,
        "Female_Pop": key * 2,
        "Total_Pop": key * 3,
        "Num_Veterans": F.when(nation != 5, nation),
        "Num_Foreign_born": nation + 7,
        "Avg_Household_Size": F.col("c_acctbal") / 3,
        "State_Code": F.concat(F.lit("S"), F.col("n_nationkey").cast("string")),
        "Race": F.col("c_mktsegment"),
        "Count": key,
    }
    return _as(cities, schemas.DEMOGRAPHICS, values)


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    key, nation = F.col("s_suppkey").cast("string"), F.col("s_nationkey")
    values = {
        "ident": F.when(nation != 4, F.concat(F.lit("K"), key)),
        "type": F.lit("small_airport"),
        "name": F.col("s_name"),
        "elevation_ft": nation * 10,
        "continent": F.lit(None),
        "iso_country": F.col("n_name"),
        "iso_region": F.concat(F.lit("R"), F.col("n_regionkey").cast("string")),
        "municipality": F.col("n_name"),
        "gps_code": F.lit(None),
        "iata_code": F.concat(F.lit("P"), key),
        "local_code": F.lit(None),
        "coordinates": F.when(nation == 1, key).when(nation != 0, F.concat_ws(", ", key, nation.cast("string"))),
    }
    return _as(places, schemas.AIRPORTS, values)


def _as(df: DataFrame, schema, values: dict) -> DataFrame:
    return df.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
