"""Text moderation on Spark: lexicons, cleaning, matching, training sets, classifiers, streams."""
