"""Memory that the driver's JVM has freed must not stay with it through all queries of a session."""

import platform
from pathlib import Path
from types import SimpleNamespace

import pytest

from velora.llm.common import collect_finished, shared_table


def anonymous_mb(pid):
    lines = dict(x.split(":") for x in Path(f"/proc/{pid}/status").read_text().splitlines())
    return int(lines["RssAnon"].split()[0]) / 1024


@pytest.mark.skipif(platform.libc_ver()[0] != "glibc", reason="only glibc keeps and trims freed memory like this")
def test_freed_native_memory_of_the_driver_goes_back(spark):
    """Some 65 MB between a few pieces in use stayed with the JVM before."""
    shared_table(spark.range(10), "first")  # what earlier tests have left
    pid = spark._jvm.java.lang.ProcessHandle.current().pid()
    pieces = [spark._jvm.java.util.zip.Deflater() for _ in range(400)]  # some 260 KB outside the heap each
    for p in pieces:
        p.setInput(bytearray(range(256)) * 1024)
        p.finish()
        p.deflate(spark.sparkContext._gateway.new_array(spark._jvm.byte, 8))
    full = anonymous_mb(pid)
    for i, p in enumerate(pieces):
        if i % 20:
            p.end()
    shared_table(spark.range(10), "second")
    assert full - anonymous_mb(pid) > 30
    for p in pieces[::20]:
        p.end()


@pytest.mark.parametrize("total, used, collected", [(300, 200, 0), (500, 100, 0), (500, 200, 1), (720, 160, 1), (300, 260, 1)])
def test_a_heap_that_has_grown_is_collected(total, used, collected):
    calls = []
    heap = SimpleNamespace(totalMemory=lambda: total, freeMemory=lambda: total - used, maxMemory=lambda: 750)
    java = SimpleNamespace(Runtime=SimpleNamespace(getRuntime=lambda: heap), System=SimpleNamespace(gc=lambda: calls.append(1)))
    collect_finished(SimpleNamespace(_jvm=SimpleNamespace(java=SimpleNamespace(lang=java))))
    assert len(calls) == collected
