import threading
import time

from stationflow import session


def test_a_changed_folder_has_another_version(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3).coalesce(1).write.parquet(path)
    first = session.version(spark, path)
    assert first == session.version(spark, path)
    spark.range(4).coalesce(1).write.mode("overwrite").parquet(path)
    assert first != session.version(spark, path)


def test_threads_that_ask_together_get_one_result(spark):
    made = []

    def make():
        time.sleep(0.2)
        made.append(1)
        return object()

    found = []
    threads = [threading.Thread(target=lambda: found.append(session.once(spark, "slow", make))) for _ in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(made) == 1 and len(set(map(id, found))) == 1
