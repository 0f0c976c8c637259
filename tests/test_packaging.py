"""UDF code must reach Python workers that cannot import tickwork (any cwd, no install)."""

import subprocess
import sys

import tickwork  # noqa: F401  (registers pickle-by-value)
from pyspark import cloudpickle

from tickwork.sources.blockfiles import _decode_files


def test_udf_unpickles_without_the_package_on_path(tmp_path):
    blob = tmp_path / "f.pkl"
    blob.write_bytes(cloudpickle.dumps(_decode_files))
    code = (
        "import sys, pickle; sys.path = [p for p in sys.path if 'repo' not in p];\n"
        "import pyarrow as pa\n"
        f"f = pickle.loads(open({str(blob)!r}, 'rb').read())\n"
        "print(list(f(iter([pa.RecordBatch.from_pydict({'path': ['x'], 'content': [b'']})]))))\n"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert "[]" in out.stdout


def test_block_file_source_runs_without_the_package_on_path(tmp_path):
    from tickwork.sinks.blockfiles import encode_block
    from tickwork.sources.blockfiles import BlockFileSource

    (tmp_path / "blk00000.dat").write_bytes(encode_block(1600000000, 5) + bytes(16))
    blob = tmp_path / "src.pkl"
    blob.write_bytes(cloudpickle.dumps(BlockFileSource))
    code = (
        "import sys, pickle; sys.path = [p for p in sys.path if 'repo' not in p];\n"
        f"S = pickle.loads(open({str(blob)!r}, 'rb').read())\n"
        f"r = S({{'path': {str(tmp_path)!r}}}).reader(None)\n"
        "print([row for part in r.partitions() for b in r.read(part) for row in b.to_pylist()])\n"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert "'block_time': 1600000000, 'tx_count': Decimal('5')}" in out.stdout
