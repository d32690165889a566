"""bagwise: bag-of-tokens classification as Spark DataFrame and MLlib jobs.

A row carries a key, a class and a text holding a bag of tokens. The package
tokenizes the text with column expressions, profiles classes and tokens, makes
repeatable splits and folds, drops duplicate bags, weights classes, builds
count / TF-IDF / word2vec features, trains and tunes MLlib classifiers, scores
them and explains them.

Layout:
  sources/     table scans, declared schemas, key checks, basket builder
  functions/   column expressions: tokenizers, hash units
  operators/   DataFrame -> DataFrame operators (profile, split, prepare,
               features, metrics, joins)
  plans/       MLlib pipelines: models, tuning, explanation, scoring
  streaming/   scoring of a file stream with a fitted pipeline
"""

from bagwise.session import build_session, checkpoint_dir, materialize, release

__all__ = ["build_session", "materialize", "release", "checkpoint_dir"]
