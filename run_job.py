"""Entry point for ``spark-submit``; see ``candlemill/__main__.py``."""

from candlemill.__main__ import main

if __name__ == "__main__":
    main()
