from pathlib import Path

import pytest

from weftline import staging


def test_release_gives_free_native_memory_back(spark):
    jvm = spark.sparkContext._jvm
    status = Path(f"/proc/{jvm.java.lang.ProcessHandle.current().pid()}/statm")
    if not status.exists():
        pytest.skip("needs /proc")
    resident = lambda: int(status.read_text().split()[1]) >> 8  # noqa: E731  MB, of pages of 4 KB
    memory = jvm.org.apache.spark.unsafe.Platform
    staging.release(spark)
    before = resident()
    blocks = [memory.allocateMemory(1 << 16) for _ in range(2048)]
    for at in blocks:
        memory.setMemory(at, 1, 1 << 16)
    for n, at in enumerate(blocks):
        if n % 256 != 255:  # some are still in use, so the allocator keeps what lies below them
            memory.freeMemory(at)
    held = resident()
    staging.release(spark)
    left = resident()
    for at in blocks[255::256]:
        memory.freeMemory(at)
    assert held - before > 64
    assert held - left > 64
