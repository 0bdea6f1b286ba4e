import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

# The 16-node sample network: four directed 4-cycles and four bridges
# (fixed values, retyped from the sample file).
CYCLES16 = [(1, 2), (2, 3), (3, 4), (4, 1), (5, 6), (6, 7), (7, 8), (8, 5),
            (9, 10), (10, 11), (11, 12), (12, 9), (13, 14), (14, 15), (15, 16), (16, 13),
            (2, 5), (6, 9), (10, 13), (14, 1)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from flowstrata.session import local_session
    folder = tmp_path_factory.mktemp("checkpoint")
    s = local_session(cores="*", shuffle_partitions=8, checkpoint=str(folder))
    yield s


@pytest.fixture(scope="session")
def net16(spark):
    return spark.createDataFrame(CYCLES16, "source long, target long")


PLANTED_SQL = """
select src as source,
       case when r < 8 then cast(floor(src/20) as bigint)*20 + (src + 1 + (r*7) % 19) % 20
            else (i*7919 + 13) % 400 end as target
from (select id as i, id % 400 as src, cast(floor(id/400) as bigint) % 10 as r
      from range(0, 4000)) u"""
