"""Session tuning and scratch space."""

from types import SimpleNamespace

import pytest

from rowsieve.queries.common import scratch
from rowsieve.session import JIT_METHOD_LIMIT, OPEN_FILES_PER_TASK, tune_session

LIMIT, FILES = "spark.sql.codegen.hugeMethodLimit", "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def session(spark):
    return spark.newSession()


def test_tuning(session):
    tune_session(session)
    assert session.conf.get(LIMIT) == str(JIT_METHOD_LIMIT)
    assert session.conf.get(FILES) == str(OPEN_FILES_PER_TASK)


@pytest.mark.parametrize("own", [("4000", "9"), ("65535", "0")])
def test_own_settings_stay(session, own):
    session.conf.set(LIMIT, own[0])
    session.conf.set(FILES, own[1])
    tune_session(session)
    assert (session.conf.get(LIMIT), session.conf.get(FILES)) == own


def fake_session(checkpoint_dir, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: checkpoint_dir or default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_is_new_and_in_the_named_folder():
    session = fake_session("store://shared/scratch/", "yarn")
    first, second = scratch(session, "x"), scratch(session, "x")
    assert first != second and first.startswith("store://shared/scratch/rowsieve-x-")


def test_no_local_scratch_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch(fake_session(None, "yarn"), "x")
    assert "/rowsieve-x-" in scratch(fake_session(None, "local[2]"), "x")
