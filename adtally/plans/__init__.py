"""Daily jobs: read a log once, write every summary that comes from it."""
