"""`python -m terraweave INPUT -o OUTPUT ...`"""

import sys

from .plans.dump import main

sys.exit(main(sys.argv[1:]))
