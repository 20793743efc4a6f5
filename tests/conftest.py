import sys

import pytest

from paths import ROOT

sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cinelens.session import get_session, checkpoint_dir
    s = get_session(master="local[*]", app="cinelens-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "4g"})
    checkpoint_dir(s)  # tests have no cluster setting: a scratch folder is registered
    yield s
    s.stop()
