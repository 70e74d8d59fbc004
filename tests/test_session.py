"""Settings follow the size of the input."""

from __future__ import annotations

import pytest

from tallyhouse.session import SETTINGS, settings_for

TIB = 1024**4


@pytest.mark.parametrize(
    "size, partitions", [(0, 200), (10 * 1024**3, 200), (TIB, 8192), (100 * TIB, 819_200)]
)
def test_shuffle_partitions_grow_with_the_input(size, partitions):
    assert settings_for(size)["spark.sql.shuffle.partitions"] == str(partitions)


def test_pieces_are_as_large_at_every_size():
    small, large = settings_for(TIB), settings_for(100 * TIB)
    name = "spark.sql.files.maxPartitionBytes"
    assert large[name] == small[name]
    assert settings_for(TIB, 2**30)["spark.sql.shuffle.partitions"] == "1024"


def test_session_has_the_settings(spark):
    for name, value in SETTINGS.items():
        assert spark.conf.get(name) == value
