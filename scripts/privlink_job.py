"""spark-submit launcher: spark-submit --py-files privlink.zip scripts/privlink_job.py <step> ..."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from privlink.__main__ import main  # noqa: E402

if __name__ == "__main__":
    for name, path in main().items():
        print(f"{name}\t{path}")
