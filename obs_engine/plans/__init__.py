"""The two feeds: raw to staging, dimension, fact, daily aggregate, current status."""
