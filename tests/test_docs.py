"""The README's library example runs as written (on sf0.001 fixtures)."""

import os
import re

from reelscope.plans import fixtures as fx
from reelscope.sources import write_catalog_csv
from tests.conftest import SF_SMALL

README = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "README.md")


def test_readme_example_runs(spark, tmpdir_path):
    text = open(README).read()
    code = re.search(r"```python\n(.*?)```", text, re.S).group(1)
    # inputs where the example expects them, under a temp folder
    write_catalog_csv(fx.catalog_raw(spark, SF_SMALL), os.path.join(tmpdir_path, "catalog.csv"))
    fx.landed_submissions(spark, SF_SMALL).write.json(os.path.join(tmpdir_path, "landed/subs"))
    fx.landed_comments(spark, SF_SMALL).write.json(os.path.join(tmpdir_path, "landed/comments"))
    tag = os.path.basename(tmpdir_path).replace("-", "_")
    code = (code.replace('"catalog.csv"', repr(os.path.join(tmpdir_path, "catalog.csv")))
            .replace('"landed/subs"', repr(os.path.join(tmpdir_path, "landed/subs")))
            .replace('"landed/comments"', repr(os.path.join(tmpdir_path, "landed/comments")))
            .replace('"warehouse/shows"', repr(os.path.join(tmpdir_path, "warehouse/shows")))
            .replace('"shows"', repr(f"shows_doc_{tag}"))
            .replace(".show()", ".count()"))
    scope = {}
    exec(compile(code, "README example", "exec"), scope)
    assert spark.catalog.tableExists(f"shows_doc_{tag}")
