"""The secret scan against its SQL, on texts full of candidates."""

import random
import string

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from stenoflow.llm import secrets

KEYS = string.ascii_letters + string.digits + "+/_=-"
PARTS = [
    "example", "your-", "AAAAAAAAAAAA", "01234567", "password = 'hunter2hunter2'", 'Api_Key": "abcdefgh12"', "tokén", " ", "\n", "ä€𝄞",
    "123e4567-e89b-12d3-a456-426614174000", "AKIA" + "Q7" * 9, "secret:", "=", "ordinary words of a sentence",
]


def texts():
    r = random.Random(11)
    alphabets = [KEYS, "0123456789abcdef", "0123456789ABCDEF", string.ascii_letters, string.ascii_lowercase, string.digits, "ab1"]
    for _ in range(150):
        some = [r.choice([*PARTS, *("".join(r.choices(r.choice(alphabets), k=r.randint(10, 90))) for _ in range(12))]) for _ in range(r.randint(0, 9))]
        yield r.choice(["", " "]).join(some)


def test_scan_equals_sql(spark, tmp_path):
    rows = [*texts(), None, "", *["same secret: 1234567890"] * 2]
    table = pa.table({"doc_id": pa.array(range(len(rows)), pa.int64()), "text": pa.array(rows, pa.string())})
    pq.write_table(table, tmp_path / "documents.parquet")
    df = secrets.op1_secrets(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({secrets.OP1_SQL})").fetchall()
    got = sorted(tuple(r) for r in df.collect())
    assert got == sorted(want)
    assert sum(r[-1].count("entropy:") for r in got) > 100
