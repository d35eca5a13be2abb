import io
import subprocess
import sys
import time
import zipfile

from urbanlens import session


def test_archive_holds_the_package_and_names_its_content(tmp_path):
    name, content = session.package_archive()
    assert (name, content) == session.package_archive()  # no time stamps
    names = zipfile.ZipFile(io.BytesIO(content)).namelist()
    assert {"urbanlens/__init__.py", "urbanlens/session.py", "urbanlens/operators/recsys.py"} <= set(names) and all(n.endswith(".py") for n in names)
    (tmp_path / name).write_bytes(content)
    code = f"import sys; sys.path.insert(0, {str(tmp_path / name)!r}); import urbanlens.operators.recsys as m; print(m.__file__)"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, timeout=120)
    assert name in out.stdout, out.stderr[-500:]


def test_local_sessions_need_no_archive(spark):
    session.ship_package(spark)
    assert not any("urbanlens-" in x for x in spark.sparkContext._python_includes)


def test_release_collects_the_garbage_of_the_driver(spark):
    """Shuffle files go when the driver's references to them do."""
    jvm = spark.sparkContext._jvm
    weak = jvm.java.lang.ref.WeakReference(jvm.java.util.ArrayList())
    ends = time.time() + 30
    while weak.get() is not None and time.time() < ends:
        session.release(spark)
        time.sleep(0.2)
    assert weak.get() is None
