"""Materialisation modes, the checkpoint-folder rule, and the refresh command line."""

import os

import pytest

from procura.session import checkpoint_dir, materialize


def test_materialize_modes_keep_rows(spark):
    df = spark.range(100).selectExpr("id", "id % 7 as k")
    want = sorted(tuple(r) for r in df.collect())
    for mode in ("none", "persist", "checkpoint", "table"):
        got = materialize(df, mode)
        assert sorted(tuple(r) for r in got.collect()) == want, mode
    with pytest.raises(ValueError):
        materialize(df, "bogus")


class _Opt:
    def isDefined(self):
        return False


class _FakeSession:
    """Just enough of a session on a cluster with no checkpoint folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"

        class _jsc:
            @staticmethod
            def sc():
                class _S:
                    @staticmethod
                    def getCheckpointDir():
                        return _Opt()
                return _S()


def test_unset_checkpoint_folder_is_an_error_on_a_cluster():
    with pytest.raises(RuntimeError, match="shared storage"):
        checkpoint_dir(_FakeSession())


def test_refresh_command_line(spark, tmp, small_dir):
    from procura.plans.refresh import main
    from procura.sources.sinks import current_snapshot
    base = main(["--test-tables", small_dir, "--out", tmp, "--label", "cli"])
    assert base.endswith("snapshot=cli") and current_snapshot(spark, tmp) == base
    assert os.path.isdir(f"{base}/ledger_export_view")
