import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from checks.session import local_session  # noqa: E402
from nearkin.schema import SONG_SCHEMA  # noqa: E402
from nearkin.sources.scratch import clear_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session("4", spark__checkpoint__dir=folder, spark__sql__warehouse__dir=f"{folder}/warehouse")
    yield session
    clear_scratch(session)
    session.stop()


def _share(i, step):
    """A number from 0 to 1 that looks disorderly and is the same every time."""
    return i * step % 1.0


def song(i):
    title = f"Tune_{i}%" if i % 2 == 0 else f'Say "{i}", again'
    popularity = float("nan") if i % 7 in (2, 5) else round(_share(i, 0.3247), 2)
    return (
        f"A{i // 16:03d}", f"Band {i // 16}; and, others", f"S{i:05d}", title,
        -20.0 + 15.0 * _share(i, 0.6180), popularity, 60.0 + 120.0 * _share(i, 0.4142),
        _share(i, 0.7321), _share(i, 0.2361), (1991, 0, 1990, 1993)[i // 3 % 4],
        round(_share(i, 0.17), 1), 100.0 + i / 4,
    )


@pytest.fixture(scope="session")
def song_rows():
    return [song(i) for i in range(400)]


@pytest.fixture(scope="session")
def songs(spark, song_rows):
    return spark.createDataFrame(song_rows, SONG_SCHEMA).repartition(4).persist()
