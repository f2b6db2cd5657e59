"""Multi-step jobs: the warehouse run, the billing tick, tick replay, start claims."""
