"""Pipeline tables mapped onto the star-schema test tables.

The test tables hold no medical data, so conditions come from orders and
messages from line items, each joined to its customer (the person):

* conditions: one per order; an open order has no end date
* messages: one per line item, dated by its ship date

Only the columns a query needs are read (parquet column pruning), and the
joins are plain equi-joins on the customer / order keys that Catalyst plans
from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from privlink.functions.keys import MESSAGE_FILE_SUFFIX, encode_file_name
from privlink.schemas import LINEAGE_DOC, RESOURCE

# Column set that identifies one message row (line numbers repeat in the
# test data, so the parts and suppliers are part of the identity).
MESSAGE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
CONDITION_ID = ["condition_id"]
LINKED_ROW_ID = MESSAGE_ID + CONDITION_ID

# Fixed parameters of the mapping.
CODE_MODULUS = 40
SPELL_MODULUS = 90


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    start = F.to_date("o_orderdate")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderpriority").alias("display"),
        (F.col("o_orderkey") % CODE_MODULUS).alias("code"),
        start.alias("assertedDate"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("date"))
        .otherwise(F.date_add(start, (F.col("o_orderkey") % SPELL_MODULUS).cast("int")))
        .alias("abatementDate"),
        F.col("c_name").alias("Given_Name"),
        F.col("c_custkey").cast("string").alias("Identifier"),
        F.col("c_custkey").cast("string").alias("Synthea_UID"),
        F.col("c_mktsegment").alias("Family_Name"),
        F.col("o_orderkey").alias("condition_id"),
    )


def _owned(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with their customer, joined before the line items, which are then moved once."""
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def message_file_name(name, segment, custkey):
    return F.concat(name, F.lit("_"), segment, F.lit("_"), custkey.cast("string"), F.lit(MESSAGE_FILE_SUFFIX))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    j = li.join(_owned(o, c), li.l_orderkey == F.col("o_orderkey"))
    return j.select(
        F.col("o_custkey").cast("string").alias("SynSocial_UID"),
        F.col("c_name").alias("name"),
        F.lower("c_name").alias("screen_name"),
        F.to_date("l_shipdate").alias("created_at"),
        F.concat("l_returnflag", "l_linestatus").alias("text"),
        message_file_name(F.col("c_name"), F.col("c_mktsegment"), F.col("c_custkey")).alias("filename"),
        *MESSAGE_ID,
    )


# DuckDB text of the same two views, used by the oracle SQL.
CONDITIONS_SQL = f"""
SELECT o_orderpriority AS display,
       o_orderkey % {CODE_MODULUS} AS code,
       CAST(o_orderdate AS DATE) AS assertedDate,
       CASE WHEN o_orderstatus = 'O' THEN NULL
            ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % {SPELL_MODULUS} AS INTEGER) AS DATE) END
         AS abatementDate,
       c_name AS Given_Name,
       CAST(c_custkey AS VARCHAR) AS Identifier,
       CAST(c_custkey AS VARCHAR) AS Synthea_UID,
       c_mktsegment AS Family_Name,
       o_orderkey AS condition_id
FROM orders JOIN customer ON o_custkey = c_custkey
"""

MESSAGES_SQL = f"""
SELECT CAST(o_custkey AS VARCHAR) AS SynSocial_UID,
       c_name AS name,
       lower(c_name) AS screen_name,
       CAST(l_shipdate AS DATE) AS created_at,
       l_returnflag || l_linestatus AS text,
       c_name || '_' || c_mktsegment || '_' || CAST(c_custkey AS VARCHAR) || '{MESSAGE_FILE_SUFFIX}' AS filename,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
"""

LINKED_SQL = f"""
SELECT m.*, c.display, c.code, c.assertedDate, c.abatementDate, c.Given_Name,
       c.Identifier, c.Synthea_UID, c.Family_Name, c.condition_id
FROM ({MESSAGES_SQL}) m
LEFT JOIN ({CONDITIONS_SQL}) c
  ON m.filename = c.Given_Name || '_' || c.Family_Name || '_' || c.Identifier || '{MESSAGE_FILE_SUFFIX}'
 AND c.assertedDate <= m.created_at AND m.created_at <= c.abatementDate
"""


# Spells of mixed length, one per order and person: a day, about 30 years, or to the end of time.
MIXED_SPANS_SQL = f"""
SELECT c_name || '_' || c_mktsegment || '_' || CAST(c_custkey AS VARCHAR) || '{MESSAGE_FILE_SUFFIX}' AS person,
       o_orderkey AS condition_id,
       CAST(CASE WHEN o_orderkey % 3 = 1 THEN CAST(o_orderdate AS DATE) - 5000 ELSE CAST(o_orderdate AS DATE) END AS DATE) AS first_day,
       CAST(CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate AS DATE) + 5957
            ELSE DATE '9999-12-31' END AS DATE) AS last_day
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def mixed_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    day, kind = F.to_date("o_orderdate"), F.col("o_orderkey") % 3
    return o.join(c, o.o_custkey == c.c_custkey).select(
        message_file_name(F.col("c_name"), F.col("c_mktsegment"), F.col("c_custkey")).alias("person"),
        F.col("o_orderkey").alias("condition_id"),
        F.when(kind == 1, F.date_sub(day, 5000)).otherwise(day).alias("first_day"),
        F.when(kind == 0, day).when(kind == 1, F.date_add(day, 5957)).otherwise(F.lit("9999-12-31").cast("date")).alias("last_day"),
    )


# -- nested inputs derived from the same tables --------------------------------
#
# One bundle per order (its Condition, an Observation and, in a customer's
# first order, the Patient), one per customer without orders; one message
# document per order with its line items. An order bounds each document, so
# none grows with a person's history. Edge cases are spread by fixed rules on
# the keys.

# Fixed rules of the nested mapping.
NO_CODING_MOD = 11      # order key % 11 == 0: condition without codings
TWO_CODINGS_MOD = 5     # order key % 5 == 0: a second coding
SECOND_CODE_OFFSET = 1000
NO_NAME_MOD = 13        # customer key % 13 == 0: patient without a name
NULL_GIVEN_MOD = 17     # customer key % 17 == 0: first given name is NULL
CLINICAL_ZONE = "-04:00"
ABATEMENT_TIME = "T08:00:00-04:00"
MESSAGE_TIME_PATTERN = "EEE MMM dd HH:mm:ss +0000 yyyy"
MESSAGE_FOLDER = "hdfs:///linkage/messages/"
# Fixed rules of the CSV round trip.
NULL_TEXT_MOD, EMPTY_TEXT_MOD = 7, 5


def _null(t: str):
    return F.lit(None).cast(t)


def _resource(**given):
    return F.struct(
        *[(given[f.name] if f.name in given else _null(f.dataType.simpleString())).alias(f.name) for f in RESOURCE.fields]
    )


def _entry(resource, full_url):
    return F.struct(full_url.alias("fullUrl"), resource.alias("resource"))


def bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clinical bundles from customer and orders."""
    return keyed_bundles(spark, sf_dir).select("resourceType", "entry")


def keyed_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bundles with ``order_key``, or ``customer_key`` for a customer without orders."""
    c = table(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    cid = ck.cast("string")
    given = F.when(ck % NULL_GIVEN_MOD == 0, F.array(_null("string"), F.col("c_name"))).otherwise(
        F.array(F.col("c_name"), F.lit("Middle"))
    )
    names = F.when(ck % NO_NAME_MOD == 0, F.array().cast("array<struct<family:string,given:array<string>>>")).otherwise(
        F.array(
            F.struct(F.col("c_mktsegment").alias("family"), given.alias("given")),
            F.struct(F.lit("Alias").alias("family"), F.array(F.lit("Other")).alias("given")),
        )
    )
    patient = _entry(
        _resource(
            resourceType=F.lit("Patient"),
            id=cid,
            identifier=F.array(
                F.struct(cid.alias("value")), F.struct(F.concat(F.lit("mrn-"), cid).alias("value"))
            ),
            name=names,
        ),
        F.concat(F.lit("urn:uuid:"), cid),
    )

    o = table(spark, sf_dir, "orders")
    firsts = o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_order"))
    patients = c.join(firsts, F.col("c_custkey") == F.col("o_custkey"), "left").select("first_order", "c_custkey", patient.alias("patient"))
    ok = F.col("o_orderkey")
    coding = "array<struct<code:string,display:string>>"
    first = F.struct((ok % CODE_MODULUS).cast("string").alias("code"), F.col("o_orderpriority").alias("display"))
    second = F.struct(
        (ok % CODE_MODULUS + SECOND_CODE_OFFSET).cast("string").alias("code"),
        F.concat(F.col("o_orderpriority"), F.lit(" (secondary)")).alias("display"),
    )
    codings = (
        F.when(ok % NO_CODING_MOD == 0, F.array().cast(coding))
        .when(ok % TWO_CODINGS_MOD == 0, F.array(first, second))
        .otherwise(F.array(first))
    )
    end_text = F.when(F.col("o_orderstatus") == "O", _null("string")).otherwise(
        F.concat(
            F.date_format(F.date_add(F.to_date("o_orderdate"), (ok % SPELL_MODULUS).cast("int")), "yyyy-MM-dd"),
            F.lit(ABATEMENT_TIME),
        )
    )
    even = ok % 2 == 0
    ref = F.when(even, F.concat(F.lit("urn:uuid:"), F.col("o_custkey").cast("string"))).otherwise(
        F.concat(F.lit("Patient/"), F.col("o_custkey").cast("string"))
    )
    condition = _entry(
        _resource(
            resourceType=F.lit("Condition"),
            id=ok.cast("string"),
            code=F.struct(codings.alias("coding")),
            assertedDate=F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(CLINICAL_ZONE)),
            abatementDateTime=F.when(~even, end_text),
            abatement=F.when(even, F.struct(end_text.alias("dateTime"))),
            subject=F.struct(ref.alias("reference")),
        ),
        F.concat(F.lit("urn:uuid:cond-"), ok.cast("string")),
    )
    observation = _entry(
        _resource(resourceType=F.lit("Observation"), id=F.concat(F.lit("obs-"), ok.cast("string"))),
        F.concat(F.lit("urn:uuid:obs-"), ok.cast("string")),
    )
    by_order = o.join(patients, ok == F.col("first_order"), "left").select(
        F.lit("Bundle").alias("resourceType"),
        F.array_compact(F.array(observation, F.col("patient"), condition)).alias("entry"),
        ok.alias("order_key"),
        _null("bigint").alias("customer_key"),
    )
    alone = patients.filter(F.col("first_order").isNull()).select(
        F.lit("Bundle").alias("resourceType"), F.array("patient").alias("entry"), _null("bigint").alias("order_key"), F.col("c_custkey").alias("customer_key")
    )
    return by_order.unionByName(alone)


def _message():
    """A line item, joined to its order and customer, as a message."""
    hours = ((F.col("l_linenumber") * 3) % 24).cast("int")
    return F.struct(
        F.struct(
            F.col("o_custkey").cast("string").alias("id"),
            F.col("c_name").alias("name"),
            F.lower("c_name").alias("screen_name"),
        ).alias("user"),
        F.date_format(F.col("l_shipdate") + F.make_dt_interval(hours=hours), MESSAGE_TIME_PATTERN).alias("created_at"),
        F.concat("l_returnflag", "l_linestatus").alias("text"),
    )


def message_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message documents (``messages``, ``path``): one per order, with a message
    per line item, plus an empty document per order in status 'P'."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    name = message_file_name(F.col("c_name"), F.col("c_mktsegment"), F.col("c_custkey"))
    # one folder per order; the path's last segment (the person's file name) links it
    path = F.concat(F.lit(MESSAGE_FOLDER), F.col("o_orderkey").cast("string"), F.lit("/"), encode_file_name(name)).alias("path")
    placed = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", _message().alias("message"))

    def docs_of(customers, *by):
        j = li.join(_owned(o, customers), li.l_orderkey == F.col("o_orderkey"))
        d = j.groupBy(*by).agg(F.sort_array(F.collect_list(placed)).alias("m"))
        return d.select(F.transform("m", lambda x: x["message"]).alias("messages"), "path")

    # a path holds its order: grouped by the order too, messages stay where the join has moved them.
    # Messages of customers without a name or segment have no path and make up one document.
    named = F.col("c_name").isNotNull() & F.col("c_mktsegment").isNotNull()
    docs = docs_of(c.where(named), "o_orderkey", path).unionByName(docs_of(c.where(~named), path))
    empty = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == "P")
        .select(
            F.array().cast(docs.schema["messages"].dataType).alias("messages"),
            F.concat(F.lit(MESSAGE_FOLDER), F.lit("empty-"), F.col("o_orderkey").cast("string"), F.lit(".json")).alias("path"),
        )
    )
    return docs.unionByName(empty)


# -- documents as files ---------------------------------------------------------
#
# Texts of whole documents, over several lines each. A fixed rule on the keys
# breaks some of them off in the middle: they must give no rows.

# Fixed rules of the documents.
BUNDLE_ORDERS = 64       # order keys of a bundle document
PERSON_ORDERS = 16_384   # order keys of a message document (one person's)
BROKEN_MOD = 9           # block number % 9 == 0: the document is cut in half

_PRETTY = {"pretty": "true"}


def _document(content, broken):
    text = F.to_json(content, _PRETTY)
    return F.when(broken, F.substr(text, F.lit(1), (F.length(text) / 2).cast("int"))).otherwise(text).alias("document")


def bundle_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document): bundles of BUNDLE_ORDERS order keys, or of as many customer keys without orders."""
    b = keyed_bundles(spark, sf_dir)
    block = lambda k: F.floor(F.col(k) / BUNDLE_ORDERS)
    docs = b.groupBy(block("order_key").alias("b"), block("customer_key").alias("c")).agg(F.flatten(F.collect_list("entry")).alias("entry"))
    return docs.select(_document(F.struct(F.lit("Bundle").alias("resourceType"), "entry"), F.coalesce(F.col("b") % BROKEN_MOD == 0, F.lit(False))))


def person_folder(name, segment, custkey):
    """A person's folder name, with characters that paths escape."""
    return F.concat(name, F.lit(" +50%_"), segment, F.lit("_"), custkey.cast("string"), F.lit(MESSAGE_FILE_SUFFIX))


def person_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(person, document): message documents of a person, PERSON_ORDERS order keys each."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    j = li.join(_owned(o, c), li.l_orderkey == F.col("o_orderkey"))
    block = F.floor(F.col("o_orderkey") / PERSON_ORDERS)
    person = person_folder(F.col("c_name"), F.col("c_mktsegment"), F.col("c_custkey"))
    docs = j.groupBy(person.alias("person"), "c_custkey", block.alias("b")).agg(F.collect_list(_message()).alias("messages"))
    return docs.select("person", _document(F.struct("messages"), (F.col("c_custkey") + F.col("b")) % BROKEN_MOD == 0))


def lineage_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document): catalogue files, an array of entities each (those of BUNDLE_ORDERS keys of a kind)."""
    docs = lineage_docs(spark, sf_dir)
    name = F.col("entity.attributes.qualifiedName")
    block = F.floor(F.regexp_extract(name, r"_(\d+)@", 1).cast("long") / BUNDLE_ORDERS)
    kept = docs.groupBy(F.regexp_extract(name, "^([a-z]+)_", 1).alias("kind"), block.alias("b")).agg(F.collect_list(F.struct("entity")).alias("entities"))
    return kept.select(_document(F.col("entities"), F.lit(False)))


def lineage_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue documents: a dataset per customer and per order, a process per
    order reading its customer and writing the order. Orders that are not
    finished are written to a place of another name, which no dataset has."""
    attrs_t = LINEAGE_DOC["entity"].dataType["attributes"].dataType

    def doc(type_name, **given):
        attrs = F.struct(
            *[(given[f.name] if f.name in given else _null(f.dataType.simpleString())).alias(f.name) for f in attrs_t.fields]
        )
        return F.struct(F.lit(type_name).alias("typeName"), attrs.alias("attributes")).alias("entity")

    def ref(guid, qn):
        return F.struct(guid.alias("guid"), F.lit("hdfs_folder").alias("typeName"), F.struct(qn.alias("qualifiedName")).alias("uniqueAttributes"))

    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    cq = lambda k: F.concat(F.lit("customer_"), k.cast("string"), F.lit("@sf"))
    oq = lambda k: F.concat(F.lit("order_"), k.cast("string"), F.lit("@sf"))
    cust = c.select(
        doc(
            "hdfs_folder",
            owner=F.lit("hdfs"),
            createTime=F.col("c_custkey") * 1000,
            qualifiedName=cq(F.col("c_custkey")),
            displayName=F.concat(F.col("c_name"), F.lit(" folder")),
            name=F.col("c_name"),
            description=F.col("c_mktsegment"),
        )
    )
    done = o.select(
        doc(
            "hdfs_folder",
            owner=F.lit("hdfs"),
            createTime=F.unix_millis(F.col("o_orderdate").cast("timestamp")),
            qualifiedName=oq(F.col("o_orderkey")),
            displayName=F.lit(None).cast("string"),
            name=F.concat(F.lit("order "), F.col("o_orderkey").cast("string")),
            description=F.col("o_orderpriority"),
        )
    )
    start = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    jobs = o.select(
        doc(
            "SparkProcess",
            owner=F.lit("hdfs"),
            qualifiedName=F.concat(F.lit("job_"), F.col("o_orderkey").cast("string"), F.lit("@sf")),
            name=F.concat(F.lit("job-"), F.col("o_orderkey").cast("string"), F.lit(".py")),
            description=F.col("o_orderpriority"),
            startTime=start,
            endTime=start + 10000,
            processId=F.col("o_orderkey").cast("string"),
            inputs=F.array(ref(F.concat(F.lit("g-c-"), F.col("o_custkey").cast("string")), cq(F.col("o_custkey")))),
            outputs=F.array(
                ref(
                    F.concat(F.lit("g-o-"), F.col("o_orderkey").cast("string")),
                    F.when(F.col("o_orderstatus") == "F", oq(F.col("o_orderkey"))).otherwise(
                        F.concat(F.lit("order_"), F.col("o_orderkey").cast("string"), F.lit("@elsewhere"))
                    ),
                )
            ),
        )
    )
    return cust.unionByName(done).unionByName(jobs)
