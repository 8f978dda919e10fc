import os
import sys

import pytest


HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    from pairloom.session import build_session

    s = build_session(
        "local[4]",
        app_name="pairloom-tests",
        shuffle_partitions=8,
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def prep_small(spark):
    from pairloom import Preparation
    from pairloom.sources.corpus import documents_corpus, table
    from paths import SF_SMALL

    return Preparation(documents_corpus(table(spark, SF_SMALL, "documents")))
