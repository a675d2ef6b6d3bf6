from kudosflow.functions.scalar import is_complete, ratio, token_count

__all__ = ["is_complete", "ratio", "token_count"]
