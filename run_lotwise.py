"""Launcher for cluster submission:

    spark-submit --py-files lotwise.zip run_lotwise.py daily --log ... --variance-root ... ...

Same subcommands as ``python -m lotwise`` (see ``lotwise/__main__.py``).
"""

import sys

from lotwise.__main__ import main

if __name__ == "__main__":
    main(sys.argv[1:])
