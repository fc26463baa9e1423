"""Keyed tokens: published vectors, normalisation, and a key that no plan shows."""

from __future__ import annotations

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from queuelens.functions import privacy
from tests.conftest import explain_text

# Published test vectors of HMAC-SHA-256 (RFC 4231, cases 1-4, 6 and 7): key, message, result.
VECTORS = [
    (b"\x0b" * 20, b"Hi There", "b0344c61d8db38535ca8afceaf0bf12b881dc200c9833da726e9376c2e32cff7"),
    (b"Jefe", b"what do ya want for nothing?", "5bdcc146bf60754e6a042426089575c75a003f089d2739839dec58b964ec3843"),
    (b"\xaa" * 20, b"\xdd" * 50, "773ea91e36800e46854db8ebd09181a72959098b3ef8c122d9635514ced565fe"),
    (bytes(range(1, 26)), b"\xcd" * 50, "82558a389a443c0ea4cc819899f2083a85f0faa3e578f8077a2e3ff46729665b"),
    (b"\xaa" * 131, b"Test Using Larger Than Block-Size Key - Hash Key First", "60e431591ee0b67f0d8a26aacbf5b77f8e0bc6213728c5140546040f0ee37f54"),
    (b"\xaa" * 131, b"This is a test using a larger than block-size key and a larger than block-size data. The key needs to be hashed "
                    b"before being used by the HMAC algorithm.", "9b09ffa71b942fcb27635fbcd5b0e944bfdc63644f0713938a7f51535c3a35e2"),
]


@pytest.mark.parametrize("n", range(len(VECTORS)))
def test_published_vectors(spark, tmp_path, n):
    key, message, want = VECTORS[n]
    (tmp_path / "key").write_bytes(key)
    blocks = privacy.key_blocks(spark, str(tmp_path / "key"))
    df = spark.createDataFrame([(bytearray(message),)], "m binary").crossJoin(blocks)
    assert df.select(privacy.hmac_sha256(F.col("m"), F.col("inner"), F.col("outer"))).first()[0] == want


def test_tokens_of_ids_and_a_key_that_stays_out_of_the_plan(spark, tmp_path):
    key = b"\x00\xffsome-long-random-key-71"
    (tmp_path / "key").write_bytes(key)
    rows = spark.createDataFrame([(" cust000123\t",), ("CUST000123",), ("été",), ("",), (None,)], "customer_id string")
    got = privacy.mask_customers(rows, str(tmp_path / "key"))
    want = [hmac.new(key, x.strip().upper().encode(), hashlib.sha256).hexdigest() if x is not None else None
            for x in (" cust000123\t", "CUST000123", "été", "", None)]
    assert [r.customer_token for r in got.collect()] == want and want[0] == want[1]
    for mode in ("simple", "extended", "formatted"):
        plan = explain_text(got, mode)
        assert "random-key-71" not in plan and key.hex().upper() not in plan.upper()


def test_a_missing_or_empty_key_is_an_error(spark, tmp_path):
    rows = spark.createDataFrame([("a",)], "customer_id string")
    (tmp_path / "empty").write_bytes(b"")
    with pytest.raises(Exception, match="not one file"):
        privacy.mask_customers(rows, str(tmp_path / "empty")).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        privacy.mask_customers(rows, str(tmp_path / "none")).collect()
