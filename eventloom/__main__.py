"""``python -m eventloom [out.zip]``: build the archive for ``--py-files``."""

import sys

from eventloom.session import build_zip

print(build_zip(sys.argv[1] if len(sys.argv) > 1 else "eventloom.zip"))
