"""Re-export of the comparison digest used by tools/compare.py."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

from compare import digest  # noqa: E402,F401
