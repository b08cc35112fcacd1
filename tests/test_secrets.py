"""Keys appear in no plan text and in no event log (T11)."""

import base64
import glob
import os
import subprocess
import sys

from privlink.functions.crypto import HMAC_IPAD, HMAC_OPAD, new_key, split_key
from privlink.operators.privacy import decrypt_columns, encrypt_columns, hash_columns

HASH_KEY, SALT = b"keyed-hash-key-of-the-test", b"salt-of-the-test-0123456789abcdef"


def traces(key: str) -> list[str]:
    """Every form in which a key, pad or salt could be printed."""
    sign, enc = split_key(key)
    pads = [bytes(b ^ x for b in k.ljust(64, b"\0")) for k in (sign, HASH_KEY) for x in (HMAC_IPAD, HMAC_OPAD)]
    out = []
    for raw in [sign, enc, HASH_KEY, SALT, *pads]:
        out += [raw.hex(), raw.hex().upper(), base64.b64encode(raw).decode(), raw.hex(" ").upper(), ", ".join(str(b - 256 if b > 127 else b) for b in raw), str(list(raw))[1:-1]]
    return [key, HASH_KEY.decode(), SALT.decode(), *out]


def frames(spark, key):
    df = spark.createDataFrame([("a", "x"), ("b", None)], "rid string, v string")
    enc = encrypt_columns(df, key, cols=["v"], row_id_cols=["rid"], salt=SALT)
    return [enc, decrypt_columns(enc, key, cols=["v"], check_column="ok"), hash_columns(df, ["v"], algo="hmac-sha256", key=HASH_KEY)]


def test_no_key_in_plans(spark):
    key = new_key()
    for df in frames(spark, key):
        df.collect()
        qe = df._jdf.queryExecution()
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode
        text = qe.toString() + "".join(qe.explainString(mode.fromString(m)) for m in ("extended", "formatted", "codegen", "cost"))
        assert not [t for t in traces(key) if t in text]


def test_no_key_in_the_event_log(workdir):
    key = new_key()
    code = f"""
import sys
sys.path[:0] = [{os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r}]
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.dir", {"file://" + workdir!r}).config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false").getOrCreate())
from tests.test_secrets import frames
for i, df in enumerate(frames(spark, {key!r})):
    df.write.parquet({workdir!r} + "/out" + str(i))
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=300)
    logs = [f for f in glob.glob(workdir + "/*") if os.path.isfile(f)]
    text = "".join(open(f, errors="replace").read() for f in logs)
    assert "sha2(" in text  # the plans are in it
    assert not [t for t in traces(key) if t in text]
