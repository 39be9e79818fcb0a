import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).parents[1]))


@pytest.fixture(scope="session")
def spark():
    from daybook.session import local_session

    return local_session(cores="4", shuffle_partitions=4, memory="4g")
