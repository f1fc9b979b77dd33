import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
for folder in (HERE, os.path.join(os.path.dirname(os.path.dirname(HERE)), "tools")):
    if folder not in sys.path:
        sys.path.insert(0, folder)
