"""The digest that tools/check_oracle.py compares results by."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import digest  # noqa: E402, F401
