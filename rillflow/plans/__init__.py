"""From a transform to DataFrame plans."""
