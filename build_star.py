"""Launcher for spark-submit: ``spark-submit --py-files starloom.zip build_star.py --out ... ``."""

from starloom.__main__ import main

if __name__ == "__main__":
    main()
