"""spark-submit launcher for the pipeline stages:

    spark-submit --py-files regpanel.zip scripts/run_pipeline.py all --base … \\
        --cities … --settlements … --abbr …

(``python -m regpanel …`` does the same with a session from the builder.)
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regpanel.__main__ import main  # noqa: E402

if __name__ == "__main__":
    main()
