"""Memory of the token files' workers, which share an executor's limit with its JVM."""

import re
import subprocess
import sys
from pathlib import Path

import pytest

from vigil.llm import token_files as T
from vigil.session import settings

BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

GROWTH = """
import re, pathlib, random
from vigil.llm import token_files as T
from vigil.llm.text import give_back
def mb(of):
    return int(re.search(of + r":\\s+(\\d+)", pathlib.Path("/proc/self/status").read_text())[1]) / 1024
encoder, rng = T.Encoder(T.TOKENIZER), random.Random(5)
start = mb("VmRSS")
for _ in range(6):
    # every third word is new
    words = (f"{rng.getrandbits(24):x}" if rng.random() < 0.33 else f"w{rng.randrange(5000)}" for _ in range(T.BLOCK_CHARS // 6))
    texts, some = [], []
    for word in words:
        some.append(word)
        if len(some) == 300:
            texts.append(" ".join(some))
            some = []
    encoder.encode_all(texts)
    del texts, some
    give_back()
print(mb("VmHWM") - start, mb("VmRSS") - start)
"""


@pytest.mark.skipif(not Path("/proc/self/status").exists(), reason="memory is read from /proc")
def test_encoder_takes_little_memory_and_gives_it_back():
    run = subprocess.run([sys.executable, "-c", GROWTH], cwd=Path(__file__).parents[2], capture_output=True, text=True, check=True)
    peak, left = map(float, run.stdout.split())
    assert peak < 130 and left < 60


def test_a_task_gets_texts_in_small_batches(spark):
    docs = spark.range(0, 48, 1, 1).selectExpr("id as doc_id", "repeat('word ', 200000) as text")

    def sizes(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["bytes"])

    with settings(spark, {BYTES: str(T.BATCH_BYTES)}):
        got = [r.bytes for r in docs.mapInArrow(sizes, "bytes long").collect()]
    assert len(got) > 4 and max(got) <= T.BATCH_BYTES + 1_100_000


def test_the_sessions_own_settings_come_back(spark, tmp_path):
    seen = []
    keep = spark.conf.get(BYTES)

    class Stop(Exception):
        pass

    with pytest.raises(Stop), settings(spark, {BYTES: "12345", "vigil.test.unset": "1"}):
        seen += [spark.conf.get(BYTES), spark.conf.get("vigil.test.unset")]
        raise Stop
    assert seen == ["12345", "1"] and spark.conf.get("vigil.test.unset", None) is None
    T.write(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), str(tmp_path / "files"))
    assert re.sub(r"\D", "", spark.conf.get(BYTES)) == re.sub(r"\D", "", keep)
