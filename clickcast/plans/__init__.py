from clickcast.plans.jobs import evaluate, preprocess, train

__all__ = ["evaluate", "preprocess", "train"]
