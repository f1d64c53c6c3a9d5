import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakeproof.session import local_session

    s = local_session(cores="*", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="lakeproof-test-ckpt-")})
    yield s
    s.stop()


# Ten raw rows: three good ones, a second spelling of the third, one fault (or two) in each other.
MOCK_CSV = """location_region,amount,timestamp,risk_score,receiving_address,transaction_type
Africa,12.25,1700000000,33.0,0x1111aa,sale
Asia,0,1700000100,0,0x2222bb,transfer
Europe,7.5,1700000200,100,0x3333cc,scam
Europe,7.50,1700000200,100.0,0x3333cc,scam
Oceania,80,1700000300,12,0x4444dd,phishing
Asia,90,1700000400,12,0x5555ee,gift
Africa,-1,1700000500,-2,0x6666ff,purchase
Europe,,1700000600,,0x7777aa,sale
South America,15,4102444800,9,0x8888bb,sale
South America,16,1700000700,9,8888bb,sale
"""


@pytest.fixture
def mock_csv(tmp_path):
    path = tmp_path / "raw" / "raw_batch.csv"
    path.parent.mkdir(parents=True)
    path.write_text(MOCK_CSV)
    return str(path)
