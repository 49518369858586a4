"""The dated job: one day, a range, the whole history; and where checkpoints may go."""

import pytest

from peerscore import job
from peerscore.sources.tables import write_model


def test_days_ranges_and_all(spark, model, tmp_dir):
    root, out = f"{tmp_dir}/model", f"{tmp_dir}/ranking"
    write_model(model, root)
    days = lambda df: sorted(str(r.snapshot) for r in df.select("snapshot").distinct().collect())
    common = ["--model", root, "--ranking", out]
    assert days(job.main([*common, "--cur_date", "1996-12-31"], spark)) == ["1996-12-31"]
    assert days(job.main([*common, "--start", "1996-12-31", "--end", "1997-12-31"], spark)) == ["1996-12-31", "1997-12-31"]
    whole = job.main([*common, "--all"], spark)
    assert days(whole) == [f"{y}-12-31" for y in range(1995, 2002)]
    assert whole.groupBy("subject_id", "group_id", "snapshot").count().where("count > 1").count() == 0
    assert job.main(common, spark).count() == whole.count()  # today has no snapshot


def test_contradicting_dates_are_refused():
    with pytest.raises(SystemExit):
        job.parse(["--model", "m", "--ranking", "r", "--all", "--cur_date", "2023-01-06"])


def test_a_cluster_must_name_the_checkpoint_folder():
    from peerscore.session import checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        checkpoint_dir(Session())
